"""The training-data operators against brute force on small fixtures with nulls, ties, repeats, empty and long texts."""

import gc
import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foldwise.llm import (
    bpe_matrix, cap_filters, chat_parts, common, graph, hd_langid, jaccard_join, license_scan, mixing, quality_divergence, queries,
    shuffle_shards, suffix_dedup,
)

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rec string, size string, b int, v string, block string"


def documents(spark, rows):
    """Rows (id, text, lang, source) with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, la, s, None if t is None else len(t), "r", "z", 1, "v", "k") for i, t, la, s in rows], SCHEMA)


def odd_rows(seed=1, n=60):
    rng = random.Random(seed)
    words = ["the", "of", "und", "der", "le", "de", "alpha", "beta", "gamma", "<s>", "x,", "É", "日本"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 4, 5, 30, 90]))), rng.choice(["en", "de", None]), rng.choice(["a", "b", None]))
            for i in range(n)]
    rows += [(100, None, "en", "a"), (101, "", None, None), (None, "the of und", "en", "a"), (5, rows[5][1], "en", "b"),
             (102, "word " * 5000, "en", "a"), (103, "q" * 3000, "fr", "ü"), (104, "\n \t", "en", "b"), (105, rows[7][1], "en", "a"), rows[9]]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, odd_rows()).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return documents(spark, [(0, "", None, None)]).where("doc_id < 0")


# ---------------------------------------------------------------- batches
@pytest.mark.parametrize("name", ["op1_license_scan", "op3_shuffle_shards", "op4_language_id", "op5_jaccard_join", "op8_bpe_tokens", "op9_suffix_dedup"])
def test_batch_size_changes_nothing(spark, name):
    """Results do not depend on how rows are cut into Arrow batches; a value set by the session is left alone."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    def rows():
        return sorted(map(tuple, queries.queries()[name](spark, SF).collect()), key=str)

    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        plain = rows()
        spark.conf.set(key, "9999")
        assert rows() == plain and spark.conf.get(key) in ("9999", "9999b")
    finally:
        spark.conf.set(key, before)


# ---------------------------------------------------------------- SQL twins
@pytest.mark.parametrize("name", ["op1_license_scan", "op6_chat_format", "op7_cap_filters", "op10_mix_sources"])
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.queries()[name](spark, SF)
    cols = sorted(df.columns)
    mine = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)
    found = con.sql(queries.oracle_sql()[name])
    at = [found.columns.index(c) for c in cols]
    assert mine == sorted((tuple(r[i] for i in at) for r in found.fetchall()), key=str)


# ---------------------------------------------------------------- 1
def test_license_automata(spark, docs, nothing):
    a = license_scan.compile_template("t", "one <<beginOptional>>two <<beginOptional>>three<<endOptional>><<endOptional>> four <<var;name=v;match=[0-9]+;words=1..2>> end")
    ok = ["one four 1 end", "one two four 1 2 end", "one two three four 7 end"]
    no = ["one three four 1 end", "one four end", "one four 1 2 3 end", "one four x end", "one two four 1"]
    for text in ok + no:
        got = list(license_scan.places(text.encode().split(), a))
        assert bool(got) == (text in ok), text
    for bad in ("<<beginOptional>>a", "a<<endOptional>>", "<<beginOptional>>a<<endOptional>>", "<<what>> a"):
        with pytest.raises(ValueError):
            license_scan.compile_template("bad", bad)
    rows = [(1, "ALL rights, reserved. all-rights reserved!", None, None), (2, None, None, None), (3, "İ cc BY-nc 4.0 cc by", None, None)]
    got = {r.key: r for r in license_scan.scan_licenses(documents(spark, rows), license_scan.BASE_TEMPLATES).collect()}
    assert [(m.label, m.first_word) for m in got[1].matches] == [("reserved", 0), ("reserved", 3)]
    assert (got[2].n_words, got[2].matches) == (0, [])
    assert [m.first_word for m in got[3].matches] == [1, 6] and got[3].n_words == 8
    counted = {(r.key, r.n_words) for r in license_scan.scan_licenses(docs, license_scan.BASE_TEMPLATES).collect()}
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    assert counted == {(i, len(pattern.findall("".join(c.lower() if c.isascii() else c for c in t or "")))) for i, t, *_ in odd_rows()}
    assert license_scan.scan_licenses(nothing, license_scan.BASE_TEMPLATES).count() == 0


# ---------------------------------------------------------------- 2
def brute_quality(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    tri = Counter(tuple(w[k: k + 3]) for k in range(len(w) - 2))
    covered = {j for k in range(len(w) - 2) if tri[tuple(w[k: k + 3])] > 1 for j in (k, k + 1, k + 2)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_counts_and_distances(spark, docs, nothing):
    out = quality_divergence.quality(docs).collect()
    assert len(out) == len(odd_rows())
    got = Counter((r.key, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out)
    assert got == Counter((i, *brute_quality(t)) for i, t, *_ in odd_rows())
    assert quality_divergence.quality(nothing).count() == 0
    one = spark.createDataFrame([(1,)], "x int")
    p, q = np.array([3, 1, 0, 0, 0, 0, 4]) / 8, [0.5, 0.25, 0.25, 0, 0, 0, 0]
    m = (p + np.array(q)) / 2
    kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m, strict=True) if x > 0)
    d = one.select(quality_divergence.class_distance(F.array(*[F.lit(x).cast("long") for x in (3, 1, 0, 0, 0, 0, 4)]), q)).first()[0]
    assert d == pytest.approx(np.sqrt((kl(p) + kl(q)) / 2))
    common = F.array(F.struct(F.lit("of").alias("w"), F.lit(2).cast("long").alias("n")), F.struct(F.lit("zu").alias("w"), F.lit(1).cast("long").alias("n")))
    d = one.select(quality_divergence.word_distance(common, F.lit(10).cast("long"), {"of": 0.1, "the": 0.3})).first()[0]
    p, q = np.array([0.2, 0.1, 0, 0.7]), np.array([0.1, 0, 0.3, 0.6])
    m = (p + q) / 2
    assert d == pytest.approx(np.sqrt((kl(p) + kl(q)) / 2))


def test_quality_judges_short_texts(spark):
    """Between the base rule's 50 words and 120, word lists diverge and labelled-good prose does not."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").dropDuplicates(["doc_id"])
    good = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1").select("doc_id").distinct()
    out = quality_divergence.quality(docs).where("n_words between 50 and 119").join(
        docs.select(F.col("doc_id").alias("key"), (F.regexp_count("text", F.lit(r"\|")) > 10).alias("is_list")), "key")
    lists = [r.divergent for r in out.where("is_list").collect()]
    prose = [r.divergent for r in out.where("not is_list").join(good, F.col("key") == F.col("doc_id")).collect()]
    assert len(lists) >= 5 and 2 * sum(lists) >= len(lists), lists
    assert len(prose) >= 30 and 20 * sum(prose) <= len(prose), sum(prose)


# ---------------------------------------------------------------- 3
def test_shuffled_shards(spark, docs, nothing, tmp_path):
    out = shuffle_shards.shuffle_to_shards(docs, 4, path=str(tmp_path / "a"), bucket_bytes=2000)
    rows = out.collect()
    assert Counter((r.rec.doc_id, r.rec.text) for r in rows) == Counter((i, t) for i, t, *_ in odd_rows())
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    five = shuffle_shards.shuffle_to_shards(docs, 5, path=str(tmp_path / "b"), bucket_bytes=2000).collect()
    assert {(r.rec.doc_id, r.grown_shard) for r in rows} == {(r.rec.doc_id, r["shard"]) for r in five}
    assert all(r.grown_shard in (r["shard"], 4) for r in rows)
    again = shuffle_shards.shuffle_to_shards(docs.repartition(7), 4, path=str(tmp_path / "c"), bucket_bytes=2000).collect()
    place = lambda rs: sorted(((r["shard"], r.slot, r.rec.doc_id, r.rec.text) for r in rs), key=str)
    assert place(rows) == place(again)
    assert shuffle_shards.shuffle_to_shards(nothing, 3, path=str(tmp_path / "d")).count() == 0
    p = shuffle_shards.fisher_yates(500, 1, 2)
    assert sorted(p.tolist()) == list(range(500)) and p.tolist() != list(range(500))


# ---------------------------------------------------------------- 4
def test_language_profiles(spark, docs, nothing, monkeypatch):
    grams = np.array([[97, 98, 99]], np.uint32)
    a, b, c = (hd_langid.letter_vector(x, 64, 1).astype(int) for x in (97, 98, 99))
    assert (hd_langid.ngram_vectors(grams, 64, 1)[0] == np.roll(a, 2) * np.roll(b, 1) * c).all()
    v, n = hd_langid.bundles(["Ab c", "ab  C!", None, "1 2", "a"], dims=64, seed=1)
    assert (v[0] == v[1]).all() and n.tolist() == [3, 3, 0, 0, 1]
    full = spark.read.parquet(f"{SF}/documents.parquet")
    learned = hd_langid.learn(full)
    assert all((learned[k] == w).all() for k, w in hd_langid.learn(full.repartition(5)).items())
    scored = queries.op4_language_id(spark, SF).join(full.select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in scored if r.held_out]
    assert held and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in scored)
    out = hd_langid.predict(docs, learned, [F.col("doc_id")]).collect()
    want = [r for r in odd_rows() if not re.search(r"[^\W\d_]", r[1] or "")]
    assert sorted(str(r.rec.doc_id) for r in out if r.lang_pred == "und") == sorted(str(r[0]) for r in want)
    assert hd_langid.predict(nothing, learned, [F.col("doc_id")]).count() == 0
    kept = hd_langid.predict(docs, learned, [F.col("doc_id"), F.col("text")]).collect()  # the text travels in rec
    assert sorted((str(r.rec.doc_id), str(r.lang_pred), r.score) for r in kept) == sorted((str(r.rec.doc_id), str(r.lang_pred), r.score) for r in out)
    monkeypatch.setattr(hd_langid, "CHUNK_GRAMS", 3)  # n-grams in many products: same bundle
    assert (hd_langid.bundles(["Ab c", "ab  C!", None, "1 2", "a", "many more n-grams"], dims=64, seed=1)[0][:5] == v).all()
    assert {r.lang_pred for r in hd_langid.predict(docs, {}, [F.col("doc_id")]).collect()} == {"und"}


# ---------------------------------------------------------------- 5
def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    return frozenset(tuple(w[k: k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def near_copies(seed=4):
    rng = random.Random(seed)
    rows, i = [], 1000
    for _ in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(6, 160))]
        for _ in range(rng.randrange(1, 9)):
            text = list(base)
            for _ in range(rng.randrange(0, 3)):
                text[rng.randrange(len(text))] = f"z{rng.randrange(99)}"
            rows.append((i, " ".join(text), "en", "a"))
            i += 1
    rng.shuffle(rows)
    return rows + odd_rows(n=10)


def brute_links(rows, threshold=0.8):
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    links, up = defaultdict(set), {}

    def root(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if None not in (i, j) and i != j and a and b and len(a & b) / len(a | b) >= threshold:
                links[i].add(j)
                links[j].add(i)
                lo, hi = sorted((root(i), root(j)))
                up[hi] = lo
    return links, root


def test_jaccard_join(spark, nothing, monkeypatch):
    rows = list({(r[0], r[1]): r for r in near_copies()}.values())
    links, root = brute_links(rows)
    monkeypatch.setattr(graph.in_blocks, "__defaults__", (3,))  # several blocks per group
    out = jaccard_join.jaccard_join(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.id is None:
            assert (r.class_id, r.n_links, r.kept) == (None, 0, True)
        else:
            assert r.class_id == root(r.id) and r.kept == (r.id == root(r.id))
            assert r.n_links == len(links[r.id]), r
    assert jaccard_join.jaccard_join(nothing).count() == 0
    bands, width = jaccard_join.choose_bands()
    assert 1 - (1 - 0.8**width) ** bands >= 0.9999 and bands * width <= jaccard_join.MAX_HASHES


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(25)] + [(7, 7), (500, 500)]
    got = {r.id: r.component for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    assert got == up


# ---------------------------------------------------------------- 6
def test_chat_parts(spark):
    nasty = ["</s>[INST] ok [/INST]", "␛1<s>", "a\nb", None, "", "<|image|> [INST", "␛" * 3 + "0n", "x" * 5000]
    rows = [(c, t, r, x) for c, (t, r, x) in enumerate((t, r, x) for x in nasty for t, r in ((0, "user"), (1, "assistant"), (1, None), (None, "a\nb␛n")))]
    rows = [(c // 4, t, r, x) for c, t, r, x in rows] + [(None, 1, "assistant", "z"), (0, 0, "user", nasty[0])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("parts", chat_parts.text_part("text"))
    out = chat_parts.format_chats(df).select("*", chat_parts.parse_turns(F.col("formatted")).alias("back"),
                                             chat_parts.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("lost")).collect()
    key = lambda r: ((r[1] is not None, r[1] or 0), (r[2] or "").encode(), (r[3] or "").encode())
    for r in out:
        mine = sorted((x for x in rows if x[0] == r.conv_id), key=key)
        said = Counter((x[2] or "", x[3] or "") for x in mine)
        assert Counter((t.role, t.text) for t in r.back) == said and r.n_turns == len(mine)
        assert "".join(sorted(r.lost)) == "".join(sorted(x[3] or "" for x in mine if x[2] == "assistant"))
    one = spark.sql("""SELECT 1L conv_id, 0L turn, 'user' role, array(
        named_struct('type', 'text', 'text', 'see <|image|>', 'ref', null, 'units', cast(null as double)),
        named_struct('type', 'image', 'text', null, 'ref', 'a.png', 'units', 2.0D), named_struct('type', 'audio', 'text', null, 'ref', 'b.wav', 'units', 1.1D),
        named_struct('type', 'document', 'text', null, 'ref', null, 'units', cast(null as double))) parts""")
    r = chat_parts.format_chats(one).first()
    assert [(a.type, a.ref, a.n_tokens) for a in r.attachments] == [("image", "a.png", 128), ("audio", "b.wav", 14), ("document", None, 0)]
    assert r.formatted.count("<|image|>") == 1 and r.attachment_tokens == 142


# ---------------------------------------------------------------- 7
def test_cap_filters(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 16))
    rows, i = [], 0
    for v in base:
        for _ in range(int(rng.integers(1, 7))):
            rows.append((i, (v + rng.standard_normal(16) * rng.choice([0, 0.1, 0.2]) * 0.9).tolist(), int(rng.integers(0, 2))))
            i += 1
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None] + [1.0] * 15, 1), (904, rows[0][1], None),
             (905, rows[0][1], rows[0][2]), (None, rows[0][1], rows[0][2]), (906, [float("inf")] + [1.0] * 15, 0), (907, [], 0), (908, [1.0, 2.0], 0)]
    df = spark.createDataFrame([(a, b, c, "x", "y") for a, b, c in rows], "vec_id long, embedding array<double>, label int, v string, id string")
    out = {r.id: r for r in cap_filters.near_vectors(df).collect()}
    good = [(a, np.array(b), c) for a, b, c in rows if a is not None and c is not None and (a < 900 or a == 905)]
    links, up = defaultdict(int), {a: a for a, *_ in good}
    edges = [(a, b) for a, v, x in good for b, w, y in good if a < b and x == y and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98]
    assert len(edges) > 20
    for a, b in edges:
        links[a] += 1
        links[b] += 1
    for _ in range(50):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    assert len(out) == len(rows)
    for a, r in out.items():
        assert (r.n_links, r.component_id) == (links[a], up.get(a, a)), a
        assert r.kept == (a is None or a == up.get(a, a))


def test_filter_recall_at_the_threshold():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal(a.shape)
    b -= (b * a).sum(1, keepdims=True) * a
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    lists = [np.split(c, np.searchsorted(r, np.arange(1, 3000))) for r, c in (cap_filters.decode_list(x, 14) for x in (a, b))]
    assert all(len(np.intersect1d(x, y)) for x, y in zip(*lists, strict=True))
    rotation, words = cap_filters.product_code(64, 3, 5, 9)
    turned = a[:50] @ rotation
    whole = [np.concatenate([w[i] for w, i in zip(words, (x, y, z), strict=True)]) for x in range(5) for y in range(5) for z in range(5)]
    scores = turned @ np.array(whole).T
    r, c = cap_filters.decode_list(a[:50], 5, want=20, least=1, seed=9)
    need = cap_filters.choose_alpha(64, 5, 3, 20) * np.sqrt(3)
    for i in range(50):
        want = np.flatnonzero(scores[i] >= need)
        assert c[r == i].tolist() == (want.tolist() if len(want) else [int(scores[i].argmax())])


# ---------------------------------------------------------------- 8
def test_bpe_equals_library(spark, docs, nothing):
    import tiktoken

    path, pattern = queries.tokenizer()
    ranks = bpe_matrix.load_ranks(path)
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks.ranks, special_tokens={})
    rng = random.Random(8)
    texts = ["", "a" * 3000, "ab" * 900, "\x1c\x85 \n\n x", "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FFF), rng.randrange(0x1F300, 0x1FAFF)])) for _ in range(4000))]
    texts += ["".join(rng.choice("abcdeth \n'sIÀé0123!") for _ in range(rng.randrange(0, 300))) for _ in range(100)]
    rows = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)]).union(docs)
    out = bpe_matrix.decode(bpe_matrix.encode(rows, path, pattern, [F.col("text")]), path).collect()
    assert len(out) == len(texts) + len(odd_rows())
    for r in out:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(r.rec.text or "")
        assert bytes(r.decoded) == (r.rec.text or "").encode()
    both = bpe_matrix.encode(rows, path, pattern, [F.col("text")], decoded=True).collect()
    assert sorted(map(str, both)) == sorted(map(str, out))
    assert bpe_matrix.encode(nothing, path, pattern, [F.col("text")]).count() == 0
    small = bpe_matrix.Pieces(ranks, most=3)
    import regex
    again = [bpe_matrix.encode_texts([t], regex.compile(pattern), small)[0].tolist() for t in texts]
    assert again == [library.encode_ordinary(t) for t in texts]


# ---------------------------------------------------------------- 9
def brute_dedup(rows, width=50):
    rows = [(i, (t or "").encode()) for i, t, *_ in rows]
    first = {}
    for i, b in rows:
        for p in range(len(b) - width + 1 if i is not None else 0):
            first[b[p: p + width]] = min(i, first.get(b[p: p + width], i))
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1 if i is not None else 0):
            if first[b[p: p + width]] < i:
                gone[p: p + width] = b"\1" * width
        spans = [(m.start(), m.end() - m.start()) for m in re.finditer(b"\1+", bytes(gone))]
        out.append((i, bytes(c for c, g in zip(b, gone, strict=True) if not g), spans))
    return sorted(out, key=str)


def test_suffix_array():
    rng = np.random.default_rng(0)
    for letters in (2, 5, 200):
        text = np.append(rng.integers(0, letters, 1500), suffix_dedup.END).astype(np.uint8)
        order = suffix_dedup.suffix_array(text, 50)
        raw = text.tobytes()
        cut = [raw[i: i + 50].ljust(50, b"\0") for i in order]
        assert cut == sorted(cut) and sorted(order.tolist()) == list(range(1501))
        same = suffix_dedup.common_prefix(suffix_dedup.words8(text), order, 10)
        assert same.tolist() == [False] + [x[:10] == y[:10] for x, y in zip(cut, cut[1:], strict=False)]


@pytest.mark.parametrize("options", [{}, {"block_bytes": 2000, "hot_blocks": 1}, {"block_bytes": 3000, "kgram": 8}])
def test_suffix_dedup(spark, nothing, options):
    rng = random.Random(3)
    parts = ["".join(rng.choice("abcd é") for _ in range(rng.randrange(45, 160))) for _ in range(6)]
    rows = [(i, "".join(rng.choice([rng.choice(parts), "".join(rng.choice("abxyz") for _ in range(rng.randrange(0, 60))), "ha " * rng.randrange(0, 50)])
                        for _ in range(rng.randrange(0, 7))), None, None) for i in range(60)]
    rows += [(200, rows[5][1], None, None), (7, rows[9][1], None, None)] + odd_rows(n=10)
    rng.shuffle(rows)
    out = suffix_dedup.suffix_dedup(documents(spark, rows), [F.col("doc_id")], **options).collect()
    got = sorted(((r.id, bytes(r.kept), [(s.start, s.length) for s in r.spans]) for r in out), key=str)
    assert got == brute_dedup(rows)
    assert suffix_dedup.suffix_dedup(nothing, [F.col("doc_id")]).count() == 0


def test_common_passage_is_sent_once():
    """A passage of many blocks: its bytes go to one bucket once, and neither they nor single windows of every block."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    passage, blocks, buckets = word(1000), 40, 4
    rows = [(i, word(300) + passage + word(300)) for i in range(blocks)]
    tables = [pa.table({"block": pa.array([i], pa.int32()), "id": pa.array([i]), "k": pa.array([0]), "rec": pa.array([i]), "data": pa.array([x.encode()])})
              for i, x in rows]

    def by(column, parts):
        t = pa.concat_tables(parts)
        return [t.filter(pa.compute.equal(t[column], b)) for b in sorted(set(t[column].to_pylist()))]

    def per_block(parts):
        found = {t["block"][0].as_py(): t for t in by("block", parts)}
        return [(t, found.get(t["block"][0].as_py(), parts[0].slice(0, 0))) for t in tables]

    shared = [suffix_dedup._shared(t) for t in by("bucket", [suffix_dedup._anchors(t, 50, 20, buckets) for t in tables])]
    hashes = [suffix_dedup._hashes(t, found, 50, 20, buckets) for t, found in per_block(shared)]
    asked = [suffix_dedup._asked(t, 1000) for t in by("bucket", hashes)]
    sent = [suffix_dedup._segments(t, found, 50, buckets) for t, found in per_block(asked)]
    assert sum(len(p.as_py()) for t in sent for kind, p in zip(t["kind"], t["payload"], strict=True) if kind.as_py() == 0) < 20 * 1000 + 400 * blocks
    gone = [suffix_dedup._repeats(t, 50) for t in by("bucket", sent)]
    cut = [suffix_dedup._cut(t, found) for t, found in per_block(gone)]
    got = [(t["id"][0].as_py(), t["kept"][0].as_py(), [(s["start"], s["length"]) for s in t["spans"][0].as_py()]) for t in cut]
    assert sorted(got, key=str) == brute_dedup(rows)


def test_anchors_of_many_segments(spark):
    """Every shared anchor counts as one of too many different segments, so all is cut into windows."""
    rng = random.Random(9)
    parts = ["".join(rng.choice("abcd é") for _ in range(rng.randrange(45, 160))) for _ in range(6)]
    rows = [(i, "".join(rng.choice([rng.choice(parts), "".join(rng.choice("abxyz") for _ in range(rng.randrange(0, 60))), "ha " * rng.randrange(0, 50)])
                        for _ in range(rng.randrange(0, 7))), None, None) for i in range(60)]
    rows += [(200, rows[5][1], None, None), (7, rows[9][1], None, None), (None, rows[9][1], None, None)]
    out = suffix_dedup.suffix_dedup(documents(spark, rows), [F.col("doc_id")], block_bytes=2000, hot_blocks=0).collect()
    got = sorted(((r.id, bytes(r.kept), [(s.start, s.length) for s in r.spans]) for r in out), key=str)
    assert got == brute_dedup(rows)


# ---------------------------------------------------------------- 10
def test_mixing(spark, docs, nothing):
    out = mixing.mix(docs).collect()
    rows = odd_rows()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.rec.doc_id, r["size"]) for r in out) == Counter((i, size(t)) for i, t, *_ in rows)
    total = Counter()
    for _, t, _, s in rows:
        total[s] += size(t)
    weight = {s: k % 3 + 1 for k, s in enumerate(sorted((x for x in total if x is not None)) + [None])}
    target, open_, left = {}, set(total), sum(total.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * total[s]}
        if not over:
            target |= share
            break
        target |= {s: 3 * total[s] for s in over}
        left -= sum(3 * total[s] for s in over)
        open_ -= over
    taken = Counter()
    for r in out:
        assert r.target == pytest.approx(target[r.rec.source]) and r.source_size == total[r.rec.source]
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 3
        taken[r.rec.source] += r.taken
    largest = max(r["size"] for r in out)
    assert all(abs(taken[s] - target[s]) <= 3 * largest for s in total)
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda rs: sorted((str(r.rec), r.copies) for r in rs)
    assert key(out) == key(again)
    assert mixing.emit(mixing.mix(docs)).count() == sum(r.copies for r in out)
    assert mixing.emit(mixing.mix(docs)).columns == docs.columns
    assert mixing.mix(nothing).count() == 0


# ---------------------------------------------------------------- pipeline
def test_pipeline(spark, nothing):
    import corpus_pipeline as P

    rng = random.Random(12)
    prose = lambda n: " ".join(rng.choice(["the", "of", "alpha"]) + f"{rng.randrange(10**6)}x" for _ in range(n))
    passage = " ".join(f"shared{k}" for k in range(60))
    texts = [prose(80) for _ in range(12)]
    texts[3] = texts[2]
    texts[4] = texts[1].replace("x ", "x ", 1) + " more"
    texts[6] += " " + passage
    texts[8] = passage + " " + texts[8]
    texts += ["123 456", None, ""]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    docs = documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    seen = {}
    for name, stage in P.STAGES:
        docs = stage(spark, docs, SF).cache()
        seen[name] = {r.doc_id: r.asDict() for r in docs.collect()}
    assert set(seen["language"]) == set(range(12))
    assert set(seen["near_duplicates"]) == set(range(12)) - {3, 4}
    cut = seen["repeated_substrings"]
    assert passage in cut[6]["text"] and passage not in cut[8]["text"] and cut[8]["n_chars"] == len(cut[8]["text"])
    assert all(cut[i]["text"] == texts[i] for i in (0, 1, 2, 5, 6, 7, 9, 10, 11))
    assert set(seen["mix_sources"]) <= set(cut)
    assert all(r["round_trip"] for r in seen["tokens"].values())
    empty = nothing.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in P.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_digests(spark):
    out = {r.doc_id: r for r in queries.op9_suffix_dedup(spark, SF).collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for i, kept, spans in brute_dedup(rows):
        r = out[i]
        assert (r.n_removed, r.n_spans, r.kept_sha256) == (sum(n for _, n in spans), len(spans), hashlib.sha256(kept).hexdigest())


def test_pipeline_of_odd_rows(spark):
    """NULL ids, repeated rows, ids shared by different texts, long texts, extra columns of clashing names."""
    import corpus_pipeline as P

    rng = random.Random(21)
    prose = lambda n: " ".join(rng.choice(["the", "of", "alpha"]) + f"{rng.randrange(10**6)}x" for _ in range(n))
    a, b, c, d = (prose(60) for _ in range(4))
    rows = [(1, a, "en", "s"), (1, a, "en", "s"), (2, a + " end", "en", "s"), (2, b, "en", "s"), (None, b, "en", "s"), (None, c, "en", "s"),
            (3, d, "en", "s"), (4, prose(9000), "en", "s"), (5, None, "en", "s"), (6, "", None, "s"), (7, "1 2 3", "en", "s")]
    docs = documents(spark, rows)
    kept = P.language(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() == 8
    near = P.near_duplicates(spark, kept, SF)
    assert near.columns == docs.columns
    # one row of the repeated one, the clean text that shares id 2, not the copy without an id
    assert sorted(((r.doc_id or 0), r.text) for r in near.collect()) == sorted([(1, a), (2, b), (0, c), (3, d), (4, rows[7][1])])
    for stage in (P.repeated_substrings, P.mix_sources):
        near = stage(spark, near, SF)
        assert near.columns == docs.columns
    out = P.tokens(spark, near, SF)
    assert out.count() >= 1 and out.where("NOT round_trip").count() == 0


def test_language_without_labels_keeps_texts(spark):
    import corpus_pipeline as P

    docs = documents(spark, [(0, "some words", None, "s"), (1, "été", None, None), (2, "12 !", None, "s"), (3, None, None, "s"), (4, "", None, "s")])
    assert sorted(r.doc_id for r in P.language(spark, docs, SF).collect()) == [0, 1]


def test_replacement_signs_of_the_text_stay(spark):
    import corpus_pipeline as P

    text = "a\ufffdb \ufdd1 \ufdd10 " + "é" * 3
    broken = spark.createDataFrame([(text.encode() + b"\xc3",), (b"\xa9x" + "\ufffd".encode(),)], "v binary")
    got = [r[0] for r in broken.select(P.without_broken(F.col("v").cast("string"))).collect()]
    assert got == [text, "x\ufffd"]
    shared = "é" * 24 + "Z"  # 49 bytes, cut inside a character where 50 bytes repeat
    rows = [(1, "q" + shared + "é rest \ufffd one", "en", "s"), (2, "w \ufffd " + "q" + shared + "è more \ufffd", "en", "s")]
    out = {r.doc_id: r.text for r in P.repeated_substrings(spark, documents(spark, rows), SF).collect()}
    assert out == {1: rows[0][1], 2: "w \ufffd  more \ufffd"}


def test_links_need_not_be_counted(spark, docs):
    with_links = {(r.id, r.class_id, r.kept) for r in jaccard_join.jaccard_join(docs).collect()}
    without = jaccard_join.jaccard_join(docs, count_links=False).collect()
    assert {(r.id, r.class_id, r.kept) for r in without} == with_links and all(r.n_links is None for r in without)


def test_merged_spans():
    row, start, end = suffix_dedup.merged_spans(np.array([5, 0, 2, 10, 8, 20]), np.array([3, 3, 2, 5, 2, 0]), np.array([0, 10, 10, 30]))
    assert (row.tolist(), start.tolist(), end.tolist()) == ([0, 0, 2], [0, 5, 10], [4, 10, 15])
    none = suffix_dedup.merged_spans(np.empty(0, np.int64), np.empty(0, np.int64), np.array([0, 4]))
    assert all(len(x) == 0 for x in none)


def test_spanning_links_connect_alike():
    rng = np.random.default_rng(3)
    for _ in range(60):
        hit = rng.random((int(rng.integers(1, 14)), int(rng.integers(1, 14)))) < rng.choice([0.05, 0.2, 0.8])
        i, j = jaccard_join.spanning_links(hit)
        n = sum(hit.shape)
        assert hit[i, j].all() and len(i) <= n

        def parts(pairs, rows=hit.shape[0], n=n):
            up = list(range(n))
            for _ in range(n):
                for a, b in pairs:
                    up[a] = up[rows + b] = min(up[a], up[rows + b])
            return up

        assert parts(list(zip(i, j))) == parts(list(zip(*np.nonzero(hit))))


def test_near_copies_of_an_absent_text(spark):
    """Copies that each differ from one text, which is not there: no hub is near all of them."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(40):
        words = list(base)
        for k in rng.sample(range(0, 120, 6), 2):
            words[k] = f"x{i}_{k}"
        rows.append((i, " ".join(words), "en", "s"))
    grams = [{tuple(t.split()[k: k + 5]) for k in range(116)} for _, t, _, _ in rows]
    near = [[j for j in range(40) if j != i and len(grams[i] & grams[j]) / len(grams[i] | grams[j]) >= 0.8] for i in range(40)]
    got = {r.id: r for r in jaccard_join.jaccard_join(documents(spark, rows)).collect()}
    assert [got[i].n_links for i in range(40)] == [len(x) for x in near]
    low = list(range(40))
    for _ in range(40):
        low = [min([low[i], *(low[j] for j in near[i])]) for i in range(40)]
    assert [got[i].class_id for i in range(40)] == low


def test_vectors_that_share_an_id(spark):
    """Ids on different vectors tie components; dense clusters; an empty table; extra columns; against the SQL twin."""
    rng = np.random.default_rng(7)
    centre = rng.normal(size=8)
    rows = [(i, (centre + 0.02 * rng.normal(size=8)).tolist(), 1) for i in range(150)]
    rows += [(200, rng.normal(size=8).tolist(), 1), (201, rng.normal(size=8).tolist(), 1)]
    rows += [(200, rows[3][1], 1), (201, rows[150][1], 1), (5, rng.normal(size=8).tolist(), 2), (300, [0.0] * 8, 1), (300, None, 2), (7, rows[7][1], 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, cls string, node int")
    got = sorted((r.id, r.n_links, r.component_id, r.kept) for r in cap_filters.near_vectors(df).collect())
    import pandas as pd

    embeddings = pd.DataFrame({"vec_id": [r[0] for r in rows], "embedding": [r[1] for r in rows], "label": [r[2] for r in rows]})  # noqa: F841
    want = sorted(tuple(r) for r in duckdb.sql(queries._OP7_SQL).fetchall())
    assert got == want
    assert {r[2] for r in got if r[0] in (200, 201)} == {0} and {r[2] for r in got if r[0] == 5} == {0}
    assert cap_filters.near_vectors(df.where("vec_id < 0")).count() == 0


def test_shared_counts():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, int(rng.integers(0, 20)))) for _ in range(25)]
    got = graph.shared_counts(sets[:10], sets[10:], width=16)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[10:]] for a in sets[:10]]
    assert graph.shared_counts([], sets).shape == (0, 25)


def test_similar_matrix_holds_little(monkeypatch):
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 2**60, 6000).astype(np.uint64))
    sets = [np.sort(rng.choice(base, int(n), replace=False)) for n in rng.integers(100, 130, 1600)]
    sets[900:950] = sets[:50]
    tracemalloc.start()
    hit = jaccard_join.similar_matrix(sets[:800], sets[800:], 0.8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(zip(*(x.tolist() for x in np.nonzero(hit)), strict=True)) == [(i, i + 100) for i in range(50)]
    assert peak < 35 << 20
    few = [np.unique(rng.integers(0, 12, int(n)).astype(np.uint64)) for n in rng.integers(0, 20, 40)]
    want = [[jaccard_join.jaccard(a, b) >= 0.5 for b in few[15:]] for a in few[:15]]
    for width, rows in ((3, 4), (1024, 128)):
        monkeypatch.setattr(jaccard_join, "WIDTH", width)
        monkeypatch.setattr(jaccard_join, "ROWS", rows)
        assert jaccard_join.similar_matrix(few[:15], few[15:], 0.5).tolist() == want


def test_workers_keep_no_ranks(spark, docs):
    path, pattern = queries.tokenizer()
    bpe_matrix.encode(docs.repartition(4), path, pattern, [F.col("doc_id")]).write.format("noop").mode("overwrite").save()

    def count(batches):
        n = sum(isinstance(x, bpe_matrix.Ranks) for x in gc.get_objects())
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([n] * b.num_rows, pa.int64())], names=["n"])

    assert {r.n for r in spark.range(0, 40, 1, 4).mapInArrow(count, "n long").collect()} == {0}


def _peak(work) -> int:
    tracemalloc.start()
    work()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak


def test_workers_hold_little_at_once(spark, docs):
    rng = np.random.default_rng(11)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzäöüß"))
    texts = ["".join(rng.choice(letters, 1000)) for _ in range(256)]
    hd_langid.bundles(["".join(letters)])  # the letters' vectors stay
    assert _peak(lambda: hd_langid.bundles(texts)) < 40 << 20
    t = pa.table({"id": pa.array(range(1024)), "data": pa.array([x.encode() for x in texts * 4], pa.binary())})
    assert _peak(lambda: list(suffix_dedup._chunk_runs(t.slice(0, 512), 50, 20))) < 18 << 20
    assert bpe_matrix.PIECES_KEPT <= 100_000 and bpe_matrix.CHUNK_BYTES <= 1 << 18
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        common.bound_batches(docs)
        assert int(spark.conf.get(key).rstrip("b")) <= 1 << 20
    finally:
        spark.conf.set(key, before)
