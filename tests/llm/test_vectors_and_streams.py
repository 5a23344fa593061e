"""Hard negatives, whitening and token streams against brute force, with nulls, ties, repeats, empty and long inputs."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foldwise.llm import angle_negatives, queries, token_stream, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, q string, angles int, weight string, white int, uid string"


def vectors(spark, rows):
    """Rows (id, vector, label) with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, v, la, "q", 1, "w", 2, "u") for i, v, la in rows], SCHEMA)


def odd_vectors(seed=3, n=240, dims=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(3, dims))
    rows = [(i, (centres[i % 3] + 0.6 * rng.normal(size=dims)).tolist(), int(i % 3)) for i in range(n)]
    rows += [(n + i, rows[10][1], 1) for i in range(90)]  # a third of all rows are one vector
    rows += [(900, None, 1), (901, [1.0, None] + [0.0] * (dims - 2), 1), (902, [math.nan] * dims, 1), (903, [math.inf] + [0.0] * (dims - 1), 0),
             (904, rows[3][1], None), (905, [0.0] * dims, 0), (None, rows[4][1], 1), rows[20], (30, rows[31][1], 2)]
    return rows


# ---------------------------------------------------------------- 11
def brute_negatives(rows, anchor):
    good = [(i, np.floor(256 * np.array(v)).astype(int).tolist(), la) for i, v, la in rows
            if i is not None and la is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for ai, aq, al in good:
        if not anchor(ai):
            continue
        scored = sorted((-sum(x * y for x, y in zip(aq, q)), i, la) for i, q, la in good if i != ai)
        for rank, (s, i, _) in enumerate([x for x in scored if x[2] == al][:5], 1):
            fit = [(t, j) for t, j, la in scored if la != al and -30 * s <= -100 * t <= -90 * s][:10]
            out += [(ai, i, k, j, -s, -t, rank) for k, (t, j) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 7, "anchor_rows": 3, "lane_rows": 16}, {"directions": 1}])
def test_hard_negatives_equal_brute_force(spark, blocks):
    rows = odd_vectors()
    df = vectors(spark, rows).repartition(3)
    got = angle_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, **blocks)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_hard_negatives_of_odd_tables(spark):
    def mine(rows, anchor=F.lit(True)):
        return sorted(map(tuple, angle_negatives.hard_negatives(vectors(spark, rows), anchor).collect()))

    assert mine([(1, [1.0], 1)])[:0] == [] and mine([(1, [1.0], 1)]) == []
    df = vectors(spark, [(1, [1.0], 1)])
    assert angle_negatives.hard_negatives(df.where("vec_id < 0"), F.lit(True)).count() == 0
    assert angle_negatives.hard_negatives(df, F.lit(False)).count() == 0
    assert mine([(1, [], 1), (2, [], 1), (3, [], 2)]) == sorted([(1, 2, 1, 3, 0, 0, 1), (2, 1, 1, 3, 0, 0, 1)])
    short = [(1, [1.0, 1.0], 1), (2, [1.0], 1), (3, [0.5], 2)]  # a shorter vector is filled with zeros
    assert (1, 2, 1, 3, 65536, 32768, 1) in mine(short)
    wide = [(i, np.random.default_rng(i).normal(size=3000).tolist(), i % 2) for i in range(12)]
    assert mine(wide) == brute_negatives(wide, lambda i: True)
    huge = [(i, [1e9 * (i + 1), 3.0 + i], i % 2) for i in range(6)]  # sums beyond exact doubles
    want = [(*r[:4], *[min(x, 2**63 - 1) for x in r[4:6]], r[6]) for r in brute_negatives(huge, lambda i: True)]
    assert [r for r in mine(huge) if r[4] < 2**63 - 1] == [r for r in want if r[4] < 2**63 - 1]


def test_labels_of_any_type(spark):
    rows = odd_vectors()
    df = vectors(spark, rows)
    text = F.concat(F.lit("class "), F.col("label").cast("string"))
    got = angle_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, label=text)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_score_bounds_hold_and_narrow():
    rng = np.random.default_rng(0)
    q = angle_negatives.integer_components(rng.normal(size=(300, 5)))
    q[0] = 0
    labels = rng.integers(0, 4, 300)
    units = angle_negatives.reference_directions(q, labels, 6)
    angles, norms = angle_negatives.angles_to(q, units)
    low, high = angle_negatives.score_bounds(angles, norms, angles, norms)
    exact = q @ q.T
    assert (low <= exact).all() and (exact <= high).all()
    assert (high - low < np.outer(norms, norms)).mean() > 0.2  # less than half of what the norms alone allow


# ---------------------------------------------------------------- 12
def brute_whitening(rows, k=8):
    good = [(i, v) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(1024.0 * c) + 100000 for c in v] for _, v in good])
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    return [i for i, _ in good], dev, c @ u / np.sqrt(e), e / np.trace(c.T @ c / n)


def test_whitening_equals_brute_force(spark):
    rows = odd_vectors(dims=12)
    got = whitening.whiten(vectors(spark, rows).repartition(5)).toPandas()
    ids, dev, white, share = brute_whitening(rows)
    assert len(got) == 8 * len(ids) and got.n.unique().tolist() == [len(ids)]
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    sign = {}
    for r in got.itertuples():
        at = [j for j, i in enumerate(ids) if i == r.id or (i is None and math.isnan(r.id))]
        fit = [j for j in at if dev[j] == r.deviation and abs(abs(white[j, r.component - 1]) - abs(r.whitened)) < 1e-8]
        assert fit and abs(share[r.component - 1] - r.explained) < 1e-10
        if abs(r.whitened) > 1e-3 and len(at) == 1:
            sign.setdefault(r.component, set()).add(np.sign(r.whitened) == np.sign(white[at[0], r.component - 1]))
    assert all(len(s) == 1 for s in sign.values())  # one sign for all rows


def test_whitening_weights_and_odd_tables(spark):
    rows = odd_vectors(dims=4)
    df = vectors(spark, rows)
    one = whitening.whiten(df, weights="one").toPandas()
    distinct = [(0, list(v), 0) for v in {tuple(v) for _, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)}]
    assert one.n.unique().tolist() == [len(distinct)] and one.identity_error[0] < 1e-9
    assert one.component.max() == 4 and abs(one.groupby("component").explained.first().sum() - 1) < 1e-9
    _, _, white, _ = brute_whitening(distinct)
    assert np.allclose(sorted(set(one[one.component == 1].whitened.abs().round(7))), sorted(set(np.abs(white[:, 0]).round(7))), atol=1e-6)
    assert whitening.whiten(df.where("vec_id < 0")).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [], 1), (2, None, 1)])).count() == 0
    assert whitening.whiten(vectors(spark, [(i, [1.0, 2.0], 1) for i in range(3)])).count() == 0  # no variance, no component
    mixed = whitening.whiten(vectors(spark, [(1, [1.0, 2.0], 1), (2, [2.0, 1.0], 1), (3, [1.0], 1)])).toPandas()
    assert sorted(mixed.id) == [1, 2] and mixed.n.tolist() == [2, 2]  # one direction has variance
    with pytest.raises(ValueError):
        whitening.whiten(df, weights="two")
    assert whitening.deviations(np.array([[2**40], [0]]), np.array([2**40]), 2) == [None, None] and whitening.deviations(np.array([[5], [1]]), np.array([6]), 2) == [16, 16]
    wide = [(i, np.random.default_rng(i).normal(size=700).tolist(), 0) for i in range(40)]
    assert whitening.whiten(vectors(spark, wide)).agg(F.max("identity_error"), F.count("id")).first()[1] == 320


def test_partitions_change_nothing(spark):
    df = vectors(spark, odd_vectors())
    a, b = (whitening.whiten(d).toPandas().sort_values(["id", "component", "whitened"]) for d in (df.repartition(2), df.repartition(7)))
    assert np.allclose(a.whitened, b.whitened, atol=1e-9) and (a.deviation.to_numpy() == b.deviation.to_numpy()).all()


# ---------------------------------------------------------------- 13
@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def plain_ids(path, text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


def texts(spark):
    rows = [(i, f"Text number {i}, with some words.\n  And  more {'é' * (i % 5)}") for i in range(40)]
    rows += [(50, None), (51, ""), (52, "word and  more\n" * 9000), (53, "x" * 150_000), (7, "another of id 7"), (8, rows[8][1]), (None, "no id"),
             (54, "<|endoftext|> is text"), (-3, "first"), (55, " \t\n  ")]
    rows += [(60, "copy")] * 30
    return rows, spark.createDataFrame([(i, t, "p", "f", 1) for i, t in rows], "doc_id long, text string, place string, tie string, part int")


@pytest.mark.parametrize("files", [{}, {"length": 16, "batch": 3, "file_bytes": 2000}])
def test_token_files_hold_every_document(spark, tokenizer, tmp_path, files):
    rows, df = texts(spark)
    written = token_stream.write_tokens(df.repartition(4), tokenizer, f"file://{tmp_path}/t", **files)
    got = token_stream.read_tokens(spark, written).collect()
    want = {}
    for i, t in rows:
        ids = plain_ids(tokenizer, t) + [0]
        want.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()} and all(r.masked for r in got)
    order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in order] == np.concatenate([[0], np.cumsum([r.n_tokens for r in order])[:-1]]).tolist()
    ids = [-math.inf if r.doc_id is None else r.doc_id for r in order]
    assert ids == sorted(ids) and written.tokens == sum(r.n_tokens for r in got)
    if files:
        assert len(written.files) > 5


def test_sequences_are_views_of_the_mapped_file(spark, tokenizer, tmp_path):
    rows, df = texts(spark)
    written = token_stream.write_tokens(df, tokenizer, str(tmp_path / "t"), length=32, batch=4)
    stream = []
    for _, ids_file, _, _, tokens, _ in written.files:
        reader = token_stream.SequenceReader(ids_file)
        with pa.memory_map(ids_file) as whole, pa.ipc.open_stream(whole) as plain:
            table = plain.read_all()
        mapped = np.frombuffer(pa.memory_map(ids_file).read_buffer(), np.uint8)
        n = len(table)
        for i in [*range(n), 0, n - 1]:  # any order
            ids, mask = reader.sequence(i)
            assert not ids.flags.owndata and not ids.flags.writeable and len(ids) == 32
            assert ids.dtype == np.uint16 and ids.tolist() == table["ids"][i].as_py() and mask.to_pylist() == table["mask"][i].as_py()
        with pytest.raises(IndexError):
            reader.sequence(n)
        assert {b.num_rows for b in table.to_batches()[:-1]} <= {4} and len(mapped) >= table.nbytes
        flat, marks = np.array(table["ids"].to_pylist()).ravel(), np.array(table["mask"].to_pylist()).ravel()
        assert marks[:tokens].all() and not marks[tokens:].any()
        stream.append(flat[:tokens])
        reader.close()
    assert token_stream.sequence_schema(8, 1 << 17).field("ids").type.value_type == pa.uint32()
    want = [x for i, t in sorted([(i, t) for i, t in rows if i is not None and i < 0]) for x in plain_ids(tokenizer, t) + [0]]
    head = len(plain_ids(tokenizer, "no id")) + 1
    assert np.concatenate(stream)[head: head + len(want)].tolist() == want


def test_no_documents_no_files(spark, tokenizer):
    _, df = texts(spark)
    written = token_stream.write_tokens(df.where("doc_id < -9"), tokenizer)
    assert written.files == [] and token_stream.read_tokens(spark, written).count() == 0


def test_long_texts_are_cut_where_words_begin(tokenizer):
    rng = np.random.default_rng(5)
    text = "".join(rng.choice(["a", "bc ", "  ", "\n", " 12", "é", "'s", ",", " ", "日本 "], 4000))
    cut = list(token_stream.pieces(text, 50))
    assert "".join(cut) == text and len(cut) > 20
    assert [x for p in cut for x in plain_ids(tokenizer, p)] == plain_ids(tokenizer, text)
    assert list(token_stream.pieces("x" * 200, 50)) == ["x" * 200] and list(token_stream.pieces("")) == [""]


def test_words_are_encoded_once(tokenizer, monkeypatch):
    given = []

    class Library:
        def encode_batch_fast(self, some, **kw):
            given.extend(some)
            return library.encode_batch_fast(some, **kw)

        def __getattr__(self, name):
            return getattr(library, name)

    library, spy = token_stream._tokenizer(tokenizer), Library()
    monkeypatch.setattr(token_stream, "_tokenizer", lambda path: spy)
    monkeypatch.setattr(token_stream, "_memory", token_stream.cache(lambda path: token_stream.WordMemory(path)))
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300)]
    some = [" ".join(rng.choice(words, 500)) for _ in range(40)]
    got = token_stream.encode_texts(some, tokenizer)
    assert [x.tolist() for x in got] == [x.ids for x in library.encode_batch_fast(some, add_special_tokens=False)]
    assert 0 < sum(map(len, given)) < sum(map(len, some)) / 20


@pytest.mark.parametrize("most", [0, 3000, 1 << 20])
def test_words_of_odd_texts_encode_as_whole_texts(tokenizer, most):
    rng = np.random.default_rng(7)
    signs = ["a", "B", " ", " ", "  ", "\n", "\t", "é", "я", "р", "中", "😀", "\u00a0", "\u3000", "\u2009", "\u0085", "\u1680", "\x1c", "\x00",
             "\x7f", "'s", "12", "<|endoftext|>", "_", "\u0301", "À"]
    memory = token_stream.WordMemory(tokenizer, most)
    for _ in range(40):
        some = ["".join(rng.choice(signs, rng.integers(0, 40))) for _ in range(20)]
        assert [x.tolist() for x in memory.encode(some)] == [x.tolist() for x in token_stream._encode(some, tokenizer)]  # the library, whole texts
    assert most == 1 << 20 or len(memory.slots) < 1000
    assert [len(x) for x in memory.encode(["", ""])] == [0, 0]


def test_other_tokenizers_get_whole_texts(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.WordLevel({"a": 0, "b": 1, "?": 2}, unk_token="?"))
    t.pre_tokenizer = pre_tokenizers.Whitespace()
    t.save(str(tmp_path / "t.json"))
    assert token_stream._memory(str(tmp_path / "t.json")) is None
    assert [x.tolist() for x in token_stream.encode_texts(["a b", "", "b c a"], str(tmp_path / "t.json"))] == [[0, 1], [], [1, 2, 0]]


def test_query_op13_equals_the_library(spark, tokenizer):
    got = {r.doc_id: r for r in queries.op13_token_stream(spark, SF).collect()}
    start = 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = plain_ids(tokenizer, r.text) + [0]
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
