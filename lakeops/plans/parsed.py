"""MERGE, UPDATE and DELETE statements as text: Spark's parser takes them apart, change-tracked writes carry them out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.classic.column import Column as ClassicColumn
from pyspark.sql.classic.dataframe import DataFrame as ClassicDataFrame

from lakeops.operators.changes import MergeClause, delete_where, merge_into, update_where
from lakeops.sources.snapshot import CommitResult, Lake


class UnsupportedStatement(ValueError):
    """A statement of a kind, or with a clause, that no change-tracked write expresses."""


def _items(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


def _column(spark: SparkSession, expression) -> Column:
    return ClassicColumn(spark._jvm.org.apache.spark.sql.classic.ExpressionUtils.column(expression))


def _optional(spark: SparkSession, option) -> Column | None:
    return _column(spark, option.get()) if option.isDefined() else None


def _kind(node) -> str:
    return node.getClass().getSimpleName()


@dataclass
class _Relation:
    """A table as a statement names it: the name, and what its columns are qualified with."""

    name: str
    alias: str


def _relation(plan) -> _Relation:
    alias = None
    if _kind(plan) == "SubqueryAlias":
        alias, plan = plan.alias(), plan.child()
    if _kind(plan) != "UnresolvedRelation":
        raise UnsupportedStatement("the target of a statement must be a table")
    name = ".".join(_items(plan.multipartIdentifier()))
    return _Relation(name.lower(), alias or name)


def _assigned(spark: SparkSession, assignments, target: _Relation) -> dict[str, Column]:
    """Column name to value, for assignments to columns of the target; fields of structs are refused."""
    out: dict[str, Column] = {}
    for assignment in _items(assignments):
        if _kind(assignment.key()) != "UnresolvedAttribute":
            raise UnsupportedStatement(f"cannot assign to {assignment.key().sql()}")
        parts = _items(assignment.key().nameParts())
        if len(parts) > 1 and parts[0].lower() == target.alias.lower():
            parts = parts[1:]
        if len(parts) != 1:
            raise UnsupportedStatement(f"cannot assign to {'.'.join(parts)}: not a column of {target.name}")
        if parts[0].lower() in out:
            raise UnsupportedStatement(f"column {parts[0]} is assigned twice")
        out[parts[0].lower()] = _column(spark, assignment.value())
    return out


def _clauses(spark: SparkSession, actions, target: _Relation) -> list[MergeClause]:
    out = []
    for action in _items(actions):
        kind, condition = _kind(action), _optional(spark, action.condition())
        if kind == "DeleteAction":
            out.append(MergeClause("deleted", condition))
        elif kind in ("UpdateStarAction", "InsertStarAction"):
            out.append(MergeClause("updated" if kind == "UpdateStarAction" else "inserted", condition))
        elif kind in ("UpdateAction", "InsertAction"):
            values = _assigned(spark, action.assignments(), target)
            out.append(MergeClause("updated" if kind == "UpdateAction" else "inserted", condition, values))
        else:
            raise UnsupportedStatement(f"MERGE with {kind}")
    return out


def _source(spark: SparkSession, plan) -> tuple[DataFrame, str]:
    """The source as a frame, and what its columns are qualified with."""
    frame = ClassicDataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan), spark)
    if _kind(plan) == "SubqueryAlias":
        return frame, plan.alias()
    return frame, _relation(plan).alias if _kind(plan) == "UnresolvedRelation" else "lk_source_rows"


class ParsedWrite:
    """A MERGE, UPDATE or DELETE statement. Its tables are lake tables whose views have been made; ``target`` is the one it writes."""

    KINDS = {"MergeIntoTable": "MERGE", "UpdateTable": "UPDATE", "DeleteFromTable": "DELETE"}

    def __init__(self, spark: SparkSession, text: str):
        self.spark = spark
        self.plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
        self.operation = self.KINDS.get(_kind(self.plan))
        if self.operation is None:
            raise UnsupportedStatement(f"not a MERGE, UPDATE or DELETE: {_kind(self.plan)}")
        self.relation = _relation(self.plan.targetTable() if self.operation == "MERGE" else self.plan.table())
        self.target = self.relation.name

    def run(self, lake: Lake) -> CommitResult:
        spark, plan, relation = self.spark, self.plan, self.relation
        table = lake.table(self.target)
        if self.operation == "DELETE":
            condition = plan.condition()
            always = _kind(condition) == "Literal" and condition.sql() == "true"  # no WHERE
            return delete_where(table, None if always else _column(spark, condition), relation.alias)
        if self.operation == "UPDATE":
            return update_where(table, _assigned(spark, plan.assignments(), relation), _optional(spark, plan.condition()), relation.alias)
        if plan.withSchemaEvolution():
            raise UnsupportedStatement("MERGE WITH SCHEMA EVOLUTION")
        source, named = _source(spark, plan.sourceTable())
        return merge_into(
            table,
            source,
            _column(spark, plan.mergeCondition()),
            _clauses(spark, plan.matchedActions(), relation),
            _clauses(spark, plan.notMatchedActions(), relation),
            _clauses(spark, plan.notMatchedBySourceActions(), relation),
            relation.alias,
            named,
        )
