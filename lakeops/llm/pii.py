"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier learns from the weighed votes.

All work on texts is DataFrame expressions. What reaches the driver are counts of vote and feature patterns, whose number
is bounded by the labelers and features and not by the data.
"""

from __future__ import annotations

from collections import defaultdict
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import ID, TEXT, id_and_text

#: The kinds every text is searched for, in their order, and their patterns. A quantifier that nothing
#: follows is written possessively (++), and a run of e-mail or number characters is entered at its start only; both
#: match the same places and keep the search linear in the length of a text.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Candidates for further spans. One pattern, so that candidates do not overlap each other.
CANDIDATES = {
    "contact": r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+",
    "secret": r"[A-Za-z0-9_-]{16,}",
    "name": r"(?:Mr|Mrs|Ms|Dr|Prof)\.? \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?",
    "number": r"\(?[0-9][0-9 ().-]{5,}[0-9]",
}
KINDS = [*BASE, *CANDIDATES]
#: Gazetteers: words that announce a kind, and given names.
ANNOUNCE = {
    "contact": "mail|e-mail|email|contact|write",
    "secret": "token|key|secret|password|passwd|pwd|auth|bearer|credential",
    "name": "contact|name|signed|from|dear|by",
    "number": "phone|tel|telephone|call|fax|mobile|ssn|iban|account|passport|card|id",
}
GIVEN_NAMES = "Anna|Carlos|David|Elena|Emma|Hans|James|Jean|John|Juan|Karl|Laura|Lucas|Maria|Marie|Michael|Paul|Peter|Sarah|Sofia|Thomas"
BEFORE, RUN = 32, 64
LABELERS = ("shape", "gazetteer", "context", "digits")


_PLACE = "struct<start:int,end:int,match:string>"


def _found(rows: DataFrame, patterns: dict[str, tuple[str, Column]]) -> DataFrame:
    """``rows`` with a column for each name of ``patterns``: array of (start, end, match) of its leftmost non-overlapping matches, in code points.

    A pattern comes with a cheap test that any text with a match passes. The pieces between the matches and the matches,
    in turn, add up to the text, so running sums of their lengths are the places. Matches and pieces are columns of
    their own, so that they are made once for a text and not again for every match.
    """
    text = F.col(TEXT)
    extract = {f"_m_{n}": F.when(might, F.regexp_extract_all(text, F.lit(p), F.lit(0))) for n, (p, might) in patterns.items()}
    rows = rows.withColumns(extract)
    rows = rows.withColumns({f"_g_{n}": F.when(F.size(f"_m_{n}") > 0, F.split(text, p, -1)) for n, (p, _) in patterns.items()})

    # length of a piece with the match after it, and where each stretch of RUN matches begins
    def lengths(n: str) -> Column:
        return F.zip_with(F.col(f"_m_{n}"), F.slice(f"_g_{n}", 1, F.size(f"_m_{n}")), lambda m, g: F.length(m) + F.length(g))

    def stretches(n: str) -> Column:
        def further(acc: Column, k: Column) -> Column:
            return F.concat(acc, F.array(F.element_at(acc, -1) + _total(F.slice(f"_l_{n}", k * RUN + 1, F.lit(RUN)))))

        return F.aggregate(F.sequence(F.lit(0), F.floor(F.size(f"_l_{n}") / RUN).cast("int")), F.array(F.lit(0)), further)

    def places(n: str) -> Column:
        def place(match: Column, i: Column) -> Column:
            run = F.floor(i / RUN).cast("int")
            within = _total(F.slice(f"_l_{n}", run * RUN + 1, i - run * RUN + 1))
            end = F.get(f"_r_{n}", run) + within
            return F.struct((end - F.length(match)).alias("start"), end.alias("end"), match.alias("match"))

        # a column that only a lambda names would be computed again for every element, so each is named outside too
        held = (F.size(f"_m_{n}") > 0) & (F.size(f"_l_{n}") > 0) & (F.size(f"_r_{n}") > 0)
        return F.when(held, F.transform(f"_m_{n}", place)).otherwise(F.expr(f"cast(array() as array<{_PLACE}>)"))

    rows = rows.withColumns({f"_l_{n}": lengths(n) for n in patterns})
    rows = rows.withColumns({f"_r_{n}": F.when(F.size(f"_m_{n}") > 0, stretches(n)) for n in patterns})
    rows = rows.withColumns({n: places(n) for n in patterns})
    return rows.drop(*[f"_{c}_{n}" for n in patterns for c in "mglr"])


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right: every second digit from the right is doubled, less 9 above 9."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _holds(kind: str, match: Column) -> Column:
    """Whether a match of a base kind counts."""
    digits = _digits(match)
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "card":
        return F.length(digits).between(12, 19) & _luhn(F.substring(digits, 1, 19))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _with_base(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_base``: array of (start, kind, end) of the base kinds, kind as its number, by start and kind."""
    text = F.col(TEXT)
    tests = {
        "email": F.contains(text, F.lit("@")),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"),
        "phone": F.contains(text, F.lit("+")),
    }
    rows = _found(rows, {f"_{kind}": (pattern, tests[kind]) for kind, pattern in BASE.items()})
    base = F.array_sort(F.concat(*[_kept(F.col(f"_{kind}"), kind, k) for k, kind in enumerate(BASE)]))
    return rows.withColumn("_base", base).drop(*[f"_{kind}" for kind in BASE])


def _kept(spans: Column, kind: str, k: int) -> Column:
    rows = F.filter(spans, lambda s: _holds(kind, s["match"]))
    return F.transform(rows, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end")))


def _count(spans: Column, k: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")


def _overlaps(spans: Column, start: Column, end: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < end) & (start < s["end"]))


def _any(kind: Column, by_kind: dict[str, Column]) -> Column:
    """A column by candidate kind."""
    out = F.lit(False)
    for name, column in by_kind.items():
        out = F.when(kind == KINDS.index(name), column).otherwise(out)
    return out


def _bucket(n: Column, cuts: tuple[int, ...]) -> Column:
    out = F.lit(len(cuts))
    for k, cut in reversed(list(enumerate(cuts))):
        out = F.when(n < cut, F.lit(k)).otherwise(out)
    return out


def _with_candidates(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_candidates``: array of the candidates that meet no base span.

    Each has start, kind, end, the labelers' votes (1 private, 0 not, -1 no opinion) and features.
    """
    text = F.col(TEXT)
    pattern = "(?<![A-Za-z0-9._%+-])(?:" + "|".join(CANDIDATES.values()) + ")"
    might = text.rlike(r"[0-9@]|\b(?:Mr|Mrs|Ms|Dr|Prof)\.? ")  # a long word of letters only is no candidate
    rows = _found(rows, {"_free": (pattern, might)})

    def described(s: Column) -> Column:
        match = s["match"]
        before = F.substring(text, F.greatest(s["start"] - BEFORE, F.lit(0)) + 1, F.least(s["start"], F.lit(BEFORE)))
        after = F.substring(text, s["end"] + 1, F.lit(1))
        n = F.length(_digits(match))
        kind = (
            F.when(F.contains(match, F.lit("@")), KINDS.index("contact"))
            .when(match.rlike(r"^(?:Mr|Mrs|Ms|Dr|Prof)\.? "), KINDS.index("name"))
            .when(match.rlike("[A-Za-z_]"), KINDS.index("secret"))
            .otherwise(KINDS.index("number"))
        )
        told = {k: before.rlike(rf"(?i)\b(?:{words})\b[^\n]{{0,12}}$") for k, words in ANNOUNCE.items()}
        told["name"] = told["name"] | match.rlike(rf"\b(?:{GIVEN_NAMES})\b")
        mixed = match.rlike("[0-9]") & match.rlike("[A-Za-z]")
        shape = {
            "contact": match.rlike(r"^[A-Za-z0-9._%+-]{3,}@[A-Za-z0-9-]{3,}$"),
            "secret": mixed & (match.rlike("^[0-9a-f]{24,}$") | (n * 5 >= F.length(match))),
            "name": F.lit(True),
            "number": n.between(9, 15),
        }
        quoted = before.rlike(r"[=:]\s?[\"']?$")
        told_at_all, shaped = _any(kind, told), _any(kind, shape)
        repeated = match.rlike(r"(.)\1{5}")
        votes = F.array(
            F.when(shaped, 1).otherwise(0),
            F.when(told_at_all, 1).otherwise(-1),
            F.when(quoted, 1).when(before.rlike(r"[\w/]$") | after.rlike(r"[\w/]"), 0).otherwise(-1),
            F.when(repeated, 0).when(kind == KINDS.index("name"), -1).when(n >= 8, 1).otherwise(0),
        )
        features = F.array(
            kind, _bucket(n, (1, 7, 9, 12, 16, 20, 28)), _bucket(F.length(match), (10, 16, 24, 32, 64)), told_at_all.cast("int"), quoted.cast("int"), shaped.cast("int"), repeated.cast("int")
        )
        return F.struct(s["start"].alias("start"), kind.alias("kind"), s["end"].alias("end"), votes.alias("votes"), features.alias("features"))

    free = F.filter("_free", lambda s: s["match"].rlike(r"[0-9@ ]") & ~_overlaps(F.col("_base"), s["start"], s["end"]))
    free = F.when(F.size("_base") > 0, free).otherwise(F.filter("_free", lambda s: s["match"].rlike(r"[0-9@ ]")))
    return rows.withColumn("_free", free).withColumn("_candidates", F.transform("_free", described)).drop("_free")


def reliabilities(patterns: list[tuple[int, tuple[int, ...], int]], rounds: int = 60) -> tuple[list[float], dict[int, float]]:
    """Accuracy of each labeler and share of private spans of each kind, by expectation-maximisation over (kind, votes, count).

    A labeler's vote is right with its accuracy, whatever the truth; priors of ten votes, seven of them right, and of
    two spans per kind keep both away from 0 and 1 where there is little to go by.
    """
    accuracy, share = [0.7] * len(LABELERS), defaultdict(lambda: 0.5)
    for _ in range(rounds):
        right, cast = [7.0] * len(LABELERS), [10.0] * len(LABELERS)
        private, seen = defaultdict(lambda: 1.0), defaultdict(lambda: 2.0)
        for kind, votes, n in patterns:
            p = posterior(votes, accuracy, share[kind])
            private[kind] += n * p
            seen[kind] += n
            for k, v in enumerate(votes):
                if v >= 0:
                    right[k] += n * (p if v else 1 - p)
                    cast[k] += n
        accuracy = [min(0.99, max(0.5, r / c)) for r, c in zip(right, cast)]
        share = defaultdict(lambda: 0.5, {k: private[k] / seen[k] for k in seen})
    return accuracy, dict(share)


def posterior(votes: tuple[int, ...], accuracy: list[float], share: float) -> float:
    odds = log(share / (1 - share))
    for v, a in zip(votes, accuracy):
        if v >= 0:
            odds += log(a / (1 - a)) * (1 if v else -1)
    return 1 / (1 + exp(-odds))


def span_classifier(rows: list[tuple[tuple[int, ...], float, int]], rounds: int = 300) -> dict[tuple[int, int], float]:
    """Weights of a logistic regression on one-hot features, from (features, chance of being private, count). Key (-1, 0) is the bias."""
    weight: dict[tuple[int, int], float] = defaultdict(float)
    square: dict[tuple[int, int], float] = defaultdict(lambda: 1e-8)
    total = sum(n for _, _, n in rows) or 1
    for _ in range(rounds):
        slope: dict[tuple[int, int], float] = defaultdict(float)
        for features, target, n in rows:
            keys = [(-1, 0), *enumerate(features)]
            p = 1 / (1 + exp(-max(-30.0, min(30.0, sum(weight[k] for k in keys)))))
            for k in keys:
                slope[k] += n / total * (p - target)
        for k, g in slope.items():
            g += 1e-4 * weight[k]
            square[k] += g * g
            weight[k] -= 0.3 * g / square[k] ** 0.5
    return dict(weight)


def fit_classifier(docs: DataFrame) -> dict[tuple[int, int], float]:
    """Votes of the candidates of all texts, counted by pattern, then EM and the classifier on the counts."""
    rows = _with_candidates(_with_base(id_and_text(docs).select(TEXT)))
    # the outer form: the other one adds a filter on the array, which is pushed down and finds the candidates several times over
    rows = rows.select(F.explode_outer("_candidates").alias("c")).where("c is not null")
    counted = rows.groupBy("c.kind", "c.votes", "c.features").count().collect()  # one row per pattern
    accuracy, share = reliabilities([(r["kind"], tuple(r["votes"]), r["count"]) for r in counted])
    return span_classifier([(tuple(r["features"]), posterior(tuple(r["votes"]), accuracy, share[r["kind"]]), r["count"]) for r in counted])


def with_spans(rows: DataFrame, weights: dict[tuple[int, int], float]) -> DataFrame:
    """``rows`` (a column text without nulls; other names must not begin with _) with ``_spans``: array of (start, kind, end) of all spans by start and kind."""
    rows = _with_candidates(_with_base(rows))

    def chosen(c: Column) -> Column:
        score = F.lit(weights.get((-1, 0), -1.0))
        for k in range(7):
            by = F.lit(0.0)
            for (place, value), w in weights.items():
                if place == k:
                    by = F.when(c["features"][k] == value, F.lit(w)).otherwise(by)
            score = score + by
        return score >= 0

    added = F.transform(F.filter("_candidates", chosen), lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    return rows.withColumn("_spans", F.array_sort(F.concat("_base", added))).drop("_candidates")


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The base kinds are found by pattern and check; the span classifier adds spans that meet none of them. It is fitted
    on the votes of all candidates in ``docs``; without candidates nothing is added. Null and empty texts have no
    spans, repeated rows are searched each, null ids stay. Two scans, no shuffle but of the pattern counts.
    """
    rows = with_spans(id_and_text(docs), fit_classifier(docs))
    counts = [_count(F.col("_base"), k).alias(f"n_{kind}") for k, kind in enumerate(BASE)]
    return rows.select(ID, *counts, F.sha2(span_text(F.col("_base")), 256).alias("base_sha256"), span_text(F.col("_spans")).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """A text with its spans replaced by their kind in capitals and brackets; overlapping spans become one mask."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        kept = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(fresh, F.concat(acc["out"], kept, F.element_at(names, s["kind"] + 1))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
