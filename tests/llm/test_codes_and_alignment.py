"""Vector codes, tokenizer alignment and the merge automaton against plain code and the libraries."""

import collections
import hashlib
import random
from bisect import bisect_right

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm import alignment, automaton, vector_codes
from lakeops.llm.common import CACHE
from lakeops.llm.queries import ORACLES, QUERIES
from tests.llm.test_operators import LONG, ODD, SF, documents, none, odd  # noqa: F401
from tests.oracle import compare

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# -- merge automaton ------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def compiled():
    return automaton.MergeAutomaton(BYTES)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


def ids_of(compiled, text, special=True):
    return np.frombuffer(compiled.encode(text, special), "<u4").tolist()


@pytest.mark.parametrize("alphabet", ["ab", "aA e'", "hetins ", "é中文a", "a", "\U0001f600ab1 2", "=-_", " \n\tx", "12 3", "\0\x7f\x80"])
def test_automaton_makes_the_librarys_ids(compiled, library, alphabet):
    rng = random.Random(alphabet)
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(compiled, text) == want, text
        assert compiled.decode(compiled.encode(text)) == library.decode(want, skip_special_tokens=False) == text


def test_automaton_special_strings_and_long_words(compiled, library):
    for text in ("<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", LONG, "x" * 100_000, "ab" * 50_000, "é" * 20_000):
        assert ids_of(compiled, text) == library.encode(text, add_special_tokens=False).ids
    library.encode_special_tokens = True
    assert ids_of(compiled, "a<|endoftext|>", special=False) == library.encode("a<|endoftext|>", add_special_tokens=False).ids
    library.encode_special_tokens = False
    assert compiled.decode(np.array([50256, 1], "<u4").tobytes()) == library.decode([50256, 1], skip_special_tokens=False)
    half = library.encode("é中", add_special_tokens=False).ids[:1]
    assert compiled.decode(np.array(half * 2, "<u4").tobytes()) == library.decode(half * 2, skip_special_tokens=False)


def test_arcs_of_the_automaton_are_rows_that_merging_keeps(compiled, library):
    """An arc t leaves the state of u exactly when the library leaves the text of u and t as these two tokens."""
    rng = random.Random(3)
    split = library.pre_tokenizer
    library.pre_tokenizer = None
    try:
        letters = automaton.byte_letters()
        spelled = lambda t: "".join(letters[b] for b in compiled.bytes[t])
        for _ in range(3_000):
            u, t = rng.randrange(256, 3_000), rng.randrange(256, 3_000)
            kept = library.encode(spelled(u) + spelled(t), add_special_tokens=False).ids == [u, t]
            assert compiled.leaves(u, t) == kept, (u, t)
    finally:
        library.pre_tokenizer = split


def test_a_merge_of_equal_halves_takes_the_leftmost(tmp_path):
    import json

    letters = automaton.byte_letters()
    vocab = {c: k for k, c in enumerate(letters)} | {"aa": 256, "ab": 257, "aab": 258}
    spec = json.load(open(BYTES, encoding="utf-8"))
    spec["model"] |= {"vocab": vocab, "merges": [["a", "a"], ["a", "b"], ["aa", "b"]]}
    spec["added_tokens"] = []
    path = tmp_path / "small.json"
    path.write_text(json.dumps(spec))
    own, theirs = automaton.MergeAutomaton(str(path)), Tokenizer.from_file(str(path))
    rng = random.Random(5)
    for _ in range(2_000):
        text = "".join(rng.choice("aaab") for _ in range(rng.randint(0, 24)))
        assert ids_of(own, text) == theirs.encode(text, add_special_tokens=False).ids, text


def test_round_trip_query_against_the_library(spark, library):
    rows = QUERIES["op13_merge_automaton"](spark, SF).collect()
    texts = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = []
    for doc, text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(map(tuple, rows)) == sorted(want)


def test_encode_and_decode_of_odd_rows(odd, none, library):  # noqa: F811
    encoded = automaton.encode_bpe(odd, BYTES)
    texts = collections.Counter((d, t or "") for d, t in ODD)
    assert collections.Counter((r["doc_id"], r["text"]) for r in automaton.decode_bpe(encoded, BYTES).collect()) == texts
    got = collections.Counter((r["doc_id"], tuple(r["ids"])) for r in encoded.collect())
    assert got == collections.Counter((d, tuple(library.encode(t or "", add_special_tokens=False).ids)) for d, t in ODD)
    nothing = encoded.select("doc_id", F.lit(None).cast("array<long>").alias("ids"))
    assert {r["text"] for r in automaton.decode_bpe(nothing, BYTES).collect()} == {""}
    assert automaton.encode_bpe(none, BYTES).count() == automaton.round_trip_digests(none, BYTES).count() == 0


def test_files_of_another_kind_are_refused():
    with pytest.raises(ValueError):
        automaton.MergeAutomaton(public_tokenizers.path("word_bpe_49k.json"))


# -- alignment ------------------------------------------------------------------------------------------------------


def plain_tokens(text, a, b):
    """(ids, ends) of both sides, or None."""
    whole = " " + text
    letters = {c: k for k, c in enumerate(automaton.byte_letters())}
    ids_a = a.encode(whole, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not text or b"".join(bytes_a) != whole.encode() or b"".join(bytes_b) != whole.encode():
        return None
    ends = lambda parts: np.cumsum([len(p) for p in parts]).tolist()
    return (ids_a, ends(bytes_a)), (ids_b, ends(bytes_b))


def plain_alignment(rows):
    a, b = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    found = [(doc, plain_tokens(text or "", a, b)) for doc, text in rows]
    counts, links_of = collections.Counter(), []
    for _, pair in found:
        (ids_a, ends_a), (ids_b, ends_b) = pair or (([], []), ([], []))
        at = dict(zip(ends_b, ids_b))
        links = [(i, at[e]) for i, e in zip(ids_a, ends_a) if e in at]
        counts.update(links)
        links_of.append(links)
    most = collections.defaultdict(int)
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    out = []
    for (doc, pair), links in zip(found, links_of):
        (ids_a, ends_a), (ids_b, ends_b) = pair or (([], []), ([], []))
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, low = [], 0
        for cut in cuts:
            side = lambda ids, ends: ",".join(map(str, ids[bisect_right(ends, low) : bisect_right(ends, cut)]))  # noqa: B023, E731
            groups.append(f"{side(ids_a, ends_a)}|{side(ids_b, ends_b)}")
            low = cut
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if pair else ""
        best = sum(counts[x] == most[x[1]] for x in links)
        out.append((doc, len(ids_a), len(ids_b), len(cuts), len(links), best, sum(counts[x] for x in links), digest))
    return out


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_query_against_plain_code(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    few = spark.createDataFrame(docs, "doc_id long, text string")
    got = alignment.alignment_digests(few, BYTES, PIECES).select(*COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(plain_alignment(docs))


def test_alignment_of_odd_rows(spark, odd, none):  # noqa: F811
    extra = [(20, "a▁b"), (21, "▁"), (22, "é😀\0x"), (23, "  two  spaces "), (24, "<s></s><unk> <0x41>"), (25, "\n\n"), (26, " "), (27, "ﬁ ＡＢ é")]
    rows = odd.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    got = alignment.alignment_digests(rows.withColumn("links", F.lit(1)).withColumn("n_a", F.lit(2)), BYTES, PIECES).select(*COLUMNS).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(plain_alignment(ODD + extra), key=key)
    assert alignment.alignment_digests(none, BYTES, PIECES).count() == 0
    empty = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert {tuple(r) for r in alignment.alignment_digests(empty, BYTES, PIECES).select(*COLUMNS).collect()} == {(d, 0, 0, 0, 0, 0, 0, "") for d in (1, 2)}


def test_overlaps_within_groups():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 40))
        cuts = [np.unique(np.append(rng.integers(1, n + 1, rng.integers(0, 20)), n)) for _ in "ab"]
        (sa, ea), (sb, eb) = ((np.append(0, c[:-1]), c) for c in cuts)
        i, j = alignment.overlaps(sa, ea, sb, eb)
        want = {(x, y) for x in range(len(sa)) for y in range(len(sb)) if max(sa[x], sb[y]) < min(ea[x], eb[y])}
        assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)
        ga, gb = alignment.groups_of(sa, ea, sb, eb)
        both = np.intersect1d(ea, eb)
        assert ga.tolist() == np.searchsorted(both, ea, "left").tolist() and gb.tolist() == np.searchsorted(both, eb, "left").tolist()
        assert all(ga[x] == gb[y] for x, y in want)


def test_aligned_groups_hold_all_overlaps(spark):
    rows = alignment.aligned_groups(spark.createDataFrame([(1, "hello alignment of tokens"), (2, None)], "doc_id long, text string"), BYTES, PIECES).orderBy("doc_id").collect()
    first = rows[0]
    assert sum(p["together"] for p in first["overlaps"]) == first["n_groups"] == len(first["group_ids"].split(";"))
    assert rows[1]["overlaps"] == [] and rows[1]["group_ids"] == ""


# -- vector codes ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("scale", [3, 200, 2**24, 2**29, 2**80])
def test_tree_finds_the_nearest_entry_with_ties(scale):
    rng = np.random.default_rng(scale % 97)
    for dims in (1, 2, 5):
        raw = [[int(x) * (scale // 3) for x in row] for row in rng.integers(-3, 4, (150, dims))]
        points = np.array(raw, object)
        queries = np.array([[int(x) * (scale // 6 or 1) for x in row] for row in rng.integers(-7, 8, (80, dims))], object)
        index, best = vector_codes.Gnat(points).nearest(queries)
        for q, i, d in zip(queries, index, best):
            exact = [sum((int(x) - int(y)) ** 2 for x, y in zip(q, p)) for p in raw]
            assert int(d) == min(exact) and i == exact.index(min(exact))


def test_tree_leaves_subtrees_out():
    rng = np.random.default_rng(2)
    points = np.floor(rng.normal(0, 1, (256, 2)) * 1024)
    seen = []
    whole = vector_codes.squares
    try:
        vector_codes.squares = lambda x, y: seen.append(len(x) * len(y)) or whole(x, y)
        tree = vector_codes.Gnat(points)
        seen.clear()
        tree.nearest(np.floor(rng.normal(0, 1, (1_000, 2)) * 1024))
    finally:
        vector_codes.squares = whole
    assert sum(seen) < 0.35 * 256 * 1_000


def plain_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(i, lab, [int(np.floor(1024 * float(x))) for x in v]) for i, v, lab in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][2]))
    kept = [kept[k] for k in order]
    width = len(kept[0][2]) if kept else 0
    own = [k for k in kept if len(k[2]) == width]
    each = width // parts
    cut = lambda v, p: v[p * each : (p + 1) * each]
    books = [[cut(v, p) for _, _, v in own[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            by = collections.defaultdict(list)
            for _, _, v in own:
                by[near(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(by[k]) for c in zip(*by[k])] if k in by else e for k, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, total = [], collections.defaultdict(int)
    for i, lab, v in own:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        total[lab] += sum(d for d, _ in found)
        out.append((i, lab, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return [(i, lab, code, error, total[lab], digest) for i, lab, code, error in out] + [(i, lab, None, None, total.get(lab), digest) for i, lab, v in kept if len(v) != width]


ROW = "vec_id long, embedding array<float>, label int"


def coded(spark, rows, **options):
    frame = spark.createDataFrame(rows, ROW).withColumn("v", F.lit(1)).withColumn("_label", F.lit("x")).withColumn("code", F.lit(2))
    return vector_codes.vector_codes(frame, **options).select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256").collect()


def test_codes_of_odd_rows(spark):
    rng = random.Random(11)
    rows = [(i, [rng.randint(-6, 6) / 8 for _ in range(8)], rng.choice([1, 2, None])) for i in range(60)]
    rows += rows[:5] + [(7, [0.5] * 8, 3), (None, [0.25] * 8, 1), (None, None, 1), (100, [1.0, None] * 4, 1), (101, [float("nan")] * 8, 2), (102, [float("inf")] * 8, 2), (103, None, None)]
    key = lambda r: tuple((x is not None, x) for x in r)
    for entries in (256, 10, 1):
        got = coded(spark, rows, entries=entries)
        assert sorted(map(tuple, got), key=key) == sorted(plain_codes(rows, entries=entries), key=key)
    assert coded(spark, []) == [] == coded(spark, [(1, None, 1)])
    ragged = rows + [(200, [1.0] * 4, 9), (201, [], 9)]
    assert sorted(map(tuple, coded(spark, ragged)), key=key) == sorted(plain_codes(ragged), key=key)
    assert [r["code"] for r in coded(spark, [(1, [], 1)])] == ["00000000"]
    with pytest.raises(ValueError):
        coded(spark, [(1, [1.0, 2.0], 1)])


def test_codes_of_very_large_components(spark):
    rows = [(i, [x * s for x in (1.0, -3.0, 7.0, 2.5)], 1) for i, s in enumerate((1.0, 3e5, 2e9, 4e37, -1e37, 0.0, 1e-30, 3e37, -2e37, 2e36))]
    got = {r["vec_id"]: r for r in coded(spark, rows, entries=3)}
    want = {r[0]: r for r in plain_codes([(i, [float(np.float32(x)) for x in v], lab) for i, v, lab in rows], entries=3)}
    assert len(got) == len(rows) and any(r["error"] is None for r in got.values())
    for i, row in got.items():
        assert row["code"] == want[i][2] and row["codebooks_sha256"] == want[i][5]
        assert row["error"] == (want[i][3] if want[i][3] < 2**63 else None)
        assert row["label_error"] is None


def test_codes_query_against_sql(spark):
    ok, note = compare(spark, SF, QUERIES["op11_vector_codes"], ORACLES["op11_vector_codes"])
    assert ok, note


def test_aligner_shares_its_worker_with_a_second_model():
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    few, many = alignment.Aligner(*paths, 4_000), alignment.Aligner(*paths)
    assert 2 * many.coder.words.half < CACHE
    text = "how many words does a cache hold " * 3 + " ".join(f"w{k}" for k in range(300))
    for c in ("n_a", "n_b", "n_groups", "group_ids"):
        assert few.align([text])[c].tolist() == many.align([text])[c].tolist()
