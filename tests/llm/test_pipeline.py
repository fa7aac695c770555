"""Each stage on its own input against plain Python, and the whole."""

import random
import re

import numpy as np
from pyspark.sql import functions as F
from tests.conftest import SF
from tests.llm.test_operators import brute_secrets, check_bins, docs

import corpus_pipeline as pipeline
from portflow.llm import shingles, simhash


def rows(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = rows(docs)
    kept = pipeline.language_id(spark, docs, SF)
    assert kept.columns == docs.columns
    kept = kept.checkpoint() if spark.sparkContext.getCheckpointDir() else kept
    assert len(before) >= kept.count() >= 0.97 * len(before)
    lines = pipeline.line_frequency(spark, docs, SF)
    assert lines.columns == docs.columns and set(rows(lines)) == set(before)
    for i, text in rows(lines).items():
        assert set((text or "").split("\n")) <= set((before[i] or "").split("\n"))
    near = rows(pipeline.near_dedup(spark, docs, SF))
    assert set(near) == {min(g) for g in brute_groups(before)}
    clean = rows(pipeline.secret_scan(spark, docs, SF))
    assert set(clean) == set(before)
    for i, text in clean.items():
        assert (text == before[i]) or re.search(r"\[(assign|access|hex|private_key|github|jwt)\]", text)
        assert not brute_secrets(text or "")


def brute_groups(texts):
    """texts: id -> text. The groups of ids by chains of pairs whose five-word shingle sets are similar to 0.8 or more, all pairs held against each other."""
    sets, having, root = {}, {}, {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, text in texts.items():
        words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", words) if w]
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
        for x in sets[i]:
            having.setdefault(x, []).append(i)
    for i, own in sets.items():
        shared = {}
        for x in own:
            for j in having[x]:
                shared[j] = shared.get(j, 0) + 1
        near = [j for j, n in shared.items() if n >= 0.8 * (len(own) + len(sets[j]) - n)] if own else [j for j, other in sets.items() if not other]
        for j in near:
            root[find(max(i, j))] = find(min(i, j))
    groups = {}
    for i in texts:
        groups.setdefault(find(i), set()).add(i)
    return list(groups.values())


def test_near_dedup_misses_no_group(spark):
    """On the next larger tables the groups are those of all pairs."""
    sf = SF.replace("0.001", "0.01")
    given = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute_groups(rows(given))
    assert len(want) < given.count()
    assert set(rows(pipeline.near_dedup(spark, given, sf))) == {min(g) for g in want}


def test_a_large_group_of_near_copies_is_one(spark):
    """600 variants of one text in one bucket after the other: far more than a set is held against, and one group."""
    base, rng, given = words_of(99, 120), random.Random(1), []
    for i in range(600):
        w = list(base)
        for k in rng.sample(range(120), 1):
            w[k] = f"v{i}"
        given.append((i, " ".join(w)))
    given += [(1000 + i, " ".join(words_of(500 + i, 80))) for i in range(20)]
    got = rows(pipeline.near_dedup(spark, docs(spark, given).select(*pipeline.COLUMNS), SF))
    assert set(got) == {min(g) for g in brute_groups(dict(given))}


def template_site(changed):
    """1,000 texts, each with `changed` words of a template replaced by own ones, and 400 more with partners that differ in four words besides."""
    base, given = words_of(7, 200), {}
    for i in range(1400):
        w = list(base)
        for k in range(changed):
            w[10 + 20 * k] = f"x{i}y{k}"
        given[i] = w
        if i < 400:
            w = list(w)
            for k in range(150, 190, 10):
                w[k] = f"z{i}y{k}"
            given[10_000 + i] = w
    return given


def near_pairs(texts):
    """All pairs (i, j) of texts (id -> words) that are similar to 0.8 or more, by one product of their shingle matrix."""
    ids, sets = list(texts), [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in texts.values()]
    codes = {}
    at = [(i, codes.setdefault(x, len(codes))) for i, own in enumerate(sets) for x in own]
    m = np.zeros((len(ids), len(codes)), np.float32)
    m[tuple(zip(*at, strict=True))] = 1
    both, n = m[:, m.sum(axis=0) > 1], m.sum(axis=1)
    both = both @ both.T
    return {(ids[i], ids[j]) for i, j in zip(*np.nonzero(both >= 0.8 * (n[:, None] + n - both) - 1e-4), strict=True) if ids[i] < ids[j]}


def test_pairs_of_a_template_site_are_all_found(spark):
    """Large buckets of texts that are alike but not near: all 400 pairs are found, and nothing else is linked."""
    for changed, others in ((6, 0.7345), (7, 0.697)):
        texts = template_site(changed)
        assert abs(brute_similarity(texts[0], texts[10_000]) - 0.8148) < 1e-3 and abs(brute_similarity(texts[0], texts[1]) - others) < 1e-3
        pairs = near_pairs(texts)
        assert pairs == {(i, 10_000 + i) for i in range(400)}
        given = docs(spark, [(i, " ".join(w)) for i, w in texts.items()]).select(*pipeline.COLUMNS)
        root = {r.row: r.root for r in simhash.similar_groups(given.withColumn("row", F.col("doc_id"))).collect()}
        own = {}
        for i, r in root.items():
            own.setdefault(r, set()).add(i)
        assert {tuple(sorted(x)) for x in own.values()} == pairs | {(i,) for i in range(400, 1400)}


def test_second_pass_finds_every_pair_of_a_bucket(spark, monkeypatch):
    """One bucket of 120 sets that are all roots: the edges are the pairs at 0.8 or more of all, whatever the windows hold."""
    base, texts, rng = [words_of(k, 90) for k in range(3)], {}, random.Random(3)
    for i in range(120):
        w = list(base[i % 3])
        for k in rng.sample(range(90), rng.randrange(6)):
            w[k] = rng.choice("pqrs")
        texts[i] = w[: rng.randrange(75, 91)]
    want = near_pairs(texts)
    assert 300 < len(want) < 2000
    rows_in = docs(spark, [(i, " ".join(w)) for i, w in texts.items()]).select(F.col("doc_id").alias("row"), "text")
    sets = rows_in.select(F.col("row").alias("digest"), "row", F.array(F.lit(7), *[F.col("row") + 1000 * k for k in range(1, shingles.BANDS)]).alias("bands"))
    roots = spark.createDataFrame([], "node long, root long")
    for window in (1, shingles.WINDOW):
        monkeypatch.setattr(shingles, "WINDOW", window)
        got = [tuple(sorted(r)) for r in shingles.missed(sets, roots, rows_in).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_documents_without_letters_go(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en' and n_chars > 50")
    given = given.unionByName(docs(spark, [(-1, "12 34 !!"), (-2, None)], given.first().source).select(*pipeline.COLUMNS))
    assert min(rows(pipeline.language_id(spark, given, SF))) >= 0


def words_of(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefgh", k=5)) for _ in range(n)]


def brute_similarity(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a, b))
    return len(a & b) / len(a | b)


def test_near_dedup_takes_five_words_and_0_8(spark):
    """Pairs from 0.6 to 1: those of 0.8 or more lose one, the others stay."""
    rows_in, want = [], set()
    for k in range(60):
        a = words_of(k, 200)
        b = list(a)
        for i in range(k % 10):
            b[(i * 19 + 7) % 200] = "changed"
        rows_in += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(b))]
        want |= {2 * k} | ({2 * k + 1} if brute_similarity(a, b) < 0.8 else set())
    assert 115 > len(want) > 70
    assert set(rows(pipeline.near_dedup(spark, docs(spark, rows_in).select(*pipeline.COLUMNS), SF))) == want


def test_near_dedup_null_and_repeated_ids(spark):
    a, b, c, d, e = (" ".join(words_of(k, 40)) for k in range(5))
    given = [(None, a), (None, b), (None, c), (1, c), (2, d), (2, e), (2, e), (3, None), (None, "")]
    for _ in range(2):
        got = pipeline.near_dedup(spark, docs(spark, given).select(*pipeline.COLUMNS).repartition(3), SF).collect()
        assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(i), str(t)) for i, t in [(None, a), (None, b), (1, c), (2, d), (2, e), (3, None)])


def test_run(spark):
    got = pipeline.run(spark, SF).toPandas()
    check_bins(got, 2048)
    assert got.doc_id.nunique() > 100


EDGES = [(1, None), (2, ""), (3, " \t\n"), (None, "lone words of a text that is long enough to tell"), (4, "same text of one kind"), (4, "same text of one kind"), (5, "another"), (6, "word " * 30_000)]


def test_edges_of_every_stage(spark):
    """Null, empty, blank, repeated and long texts, null ids and sources, and columns of clashing names."""
    given = docs(spark, EDGES, source=None)
    ids = lambda df: sorted(str(r.doc_id) for r in df.collect())
    every = sorted(str(i) for i, _ in EDGES)
    found = pipeline.language_id(spark, spark.read.parquet(f"{SF}/documents.parquet").unionByName(given, allowMissingColumns=True), SF)
    assert found.columns == pipeline.COLUMNS and not {"1", "2", "3"} & set(ids(found.where("source is null")))
    lines = pipeline.line_frequency(spark, given, SF)
    assert lines.columns == pipeline.COLUMNS and ids(lines) == every and {r.doc_id: r.text for r in lines.collect()}[1] is None
    near = pipeline.near_dedup(spark, given, SF)
    assert near.columns == pipeline.COLUMNS and ids(near) == ["1", "4", "5", "6", "None"]
    clean = pipeline.secret_scan(spark, given, SF)
    assert clean.columns == pipeline.COLUMNS and ids(clean) == every and {r.doc_id: r.n_chars for r in clean.collect()}[1] is None
    packed = pipeline.best_fit_packing(spark, given, SF).toPandas()
    check_bins(packed, 2048)
    assert (packed.piece == 0).sum() == len(EDGES)


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_a_scan_holds_one_segment_at_a_time():
    """Of a batch only the segment at work is Python text, and segments are small beside what numpy needs for them."""
    import pyarrow as pa

    from portflow.llm import secrets

    size = 400_000
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * size, None, "", "é" * (size // 2), "y" * 3 * size, "z"] * 3, pa.string())], ["text"])
    parts = list(secrets._segments(batch, "text"))
    assert [t for _, texts in parts for t in texts] == [t or "" for t in batch.column("text").to_pylist()]
    assert all(p.num_rows == len(texts) for p, texts in parts) and sum(p.num_rows for p, _ in parts) == 18
    assert max(sum(len(t.encode()) for t in texts[:-1]) for _, texts in parts) < 1_000_000
    assert list(secrets._segments(batch.slice(0, 0), "text")) == []
