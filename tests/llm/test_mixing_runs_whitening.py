"""Mixing, periodic runs and whitening against plain versions, and on awkward rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from podwatch.llm import mixing, periodic_runs, whitening
from podwatch.llm.mixing import mix, mixed_shards
from podwatch.llm.periodic_runs import runs_of
from podwatch.llm.queries import QUERIES, repeated_texts
from podwatch.llm.rank_one import Spectrum, updated
from podwatch.llm.suffixes import Suffixes

SF = "/root/testdata/sf0.001"


# Whitening


@pytest.mark.parametrize("size", [1, 2, 5, 24])
@pytest.mark.parametrize("kind", ["plain", "few values", "low rank", "repeated"])
def test_rank_one_updates_give_the_spectrum(size, kind):
    rng = np.random.default_rng(size)
    x = {
        "plain": lambda: rng.normal(size=(120, size)),
        "few values": lambda: rng.integers(0, 2, size=(120, size)).astype(float),
        "low rank": lambda: rng.normal(size=(120, 1)) @ rng.normal(size=(1, size)),
        "repeated": lambda: np.repeat(rng.normal(size=(4, size)), 30, axis=0),
    }[kind]() * 30 + 1000
    first, second = Spectrum(size), Spectrum(size)
    for v in x[:70]:
        first.add(v)
    for v in x[70:]:
        second.add(v)
    first.join(Spectrum.frombytes(second.tobytes(), size))
    away = x - x.mean(axis=0)
    scatter = away.T @ away
    assert np.allclose(first.vectors.T @ first.vectors, np.eye(size), atol=1e-12)
    assert np.allclose(first.vectors * first.values @ first.vectors.T, scatter, atol=1e-11 * max(1.0, np.abs(scatter).max()))
    assert np.allclose(first.values, np.linalg.eigvalsh(scatter), atol=1e-11 * max(1.0, np.abs(scatter).max()))


def test_update_by_nothing_changes_nothing():
    values, vectors = updated(np.array([1.0, 2.0]), np.eye(2), np.zeros(2))
    assert values.tolist() == [1, 2] and vectors.tolist() == np.eye(2).tolist()


def plain_whitening(vectors, components=32):
    x = np.floor(64 * np.array(vectors, dtype=np.float64)) + 1_000_000
    n = len(x)
    away = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(away.T @ away / n)
    values, axes = values[::-1], axes[:, ::-1]
    whole = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, x.sum(axis=0), strict=True)) for row in x]
    return away, values, axes, whole


def check_whitening(df, ids, vectors):
    away, values, axes, whole = plain_whitening(vectors)
    got = defaultdict(dict)
    for r in df.collect():
        got[r.vec_id][r.component] = r
    assert sorted(got) == sorted(ids)
    k = min(32, int((values > 1e-13 * values.sum()).sum()))
    matrix = np.array([[got[i][c].whitened for c in range(1, k + 1)] for i in ids])
    assert all(len(v) == k for v in got.values())
    cov = matrix.T @ matrix / len(ids)
    assert np.abs(cov - np.eye(k)).max() < 1e-9
    for r, d in zip(ids, whole, strict=True):
        assert {x.deviation for x in got[r].values()} == {d}
    one = got[ids[0]]
    assert np.allclose([one[c].explained for c in range(1, k + 1)], values[:k] / values.sum(), rtol=1e-9)
    assert {x.n for v in got.values() for x in v.values()} == {len(ids)} and all(x.identity_error < 1e-9 for v in got.values() for x in v.values())
    # Each column is the projection on a unit eigenvector: V a = e a.
    a = np.linalg.lstsq(away, matrix * np.sqrt(values[:k]), rcond=None)[0]
    assert np.allclose(away @ a, matrix * np.sqrt(values[:k]), atol=1e-7)
    return got


def test_whitening_of_the_test_embeddings(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    df = spark.read.parquet(f"{SF}/embeddings.parquet").repartition(11).withColumnsRenamed({"label": "n"})
    got = check_whitening(whitening.whitened(df), [r.vec_id for r in rows], [r.embedding for r in rows])
    away, values, axes, _ = plain_whitening([r.embedding for r in rows])
    expected = away @ axes[:, :32] / np.sqrt(values[:32])
    matrix = np.array([[got[r.vec_id][c].whitened for c in range(1, 33)] for r in rows])
    assert np.abs(matrix * np.sign((matrix * expected).sum(axis=0)) - expected).max() < 1e-6


def test_whitening_of_awkward_vectors(spark):
    rng = random.Random(5)
    good = [[rng.uniform(-3, 3) for _ in range(3)] for _ in range(40)] + [[1.0, 1.0, 1.0]] * 15
    bad = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [1.0, float("inf"), 2.0], [1.0, 2.0], [1.0] * 4]
    rows = [(k, v, "x", 1) for k, v in enumerate([*good, *bad])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string, x int").repartition(5)
    check_whitening(whitening.whitened(df), list(range(len(good))), good)
    assert whitening.whitened(df.where("vec_id >= 55")).count() in (0,)
    assert whitening.whitened(df.limit(0)).count() == 0 and whitening.whitened(df.where("vec_id = 1")).count() == 0
    assert whitening.whitened(df.where("vec_id between 40 and 54")).count() == 0  # no variance
    flat = spark.createDataFrame([(k, [float(k), 7.0, 2.0 * k]) for k in range(9)], "vec_id long, embedding array<float>")
    assert {r.component for r in whitening.whitened(flat).collect()} == {1}
    with pytest.raises(Exception, match="2\\^40"):
        whitening.whitened(spark.createDataFrame([(1, [2.0**41]), (2, [0.0])], "vec_id long, embedding array<double>")).collect()


def test_deviations_that_need_more_than_a_long():
    x = np.array([[0, 10], [2**40, 5], [3, 2**39]], dtype=np.int64)
    sums = [int(s) for s in x.sum(axis=0)]
    assert whitening._deviations(x, 3, sums) == [None] * 3 or all(d is None or d < 2**63 for d in whitening._deviations(x, 3, sums))
    small = np.array([[1, 2], [3, 5], [8, 8]], dtype=np.int64)
    s = [int(v) for v in small.sum(axis=0)]
    assert whitening._deviations(small, 3, s) == [sum((3 * int(v) - t) ** 2 for v, t in zip(r, s, strict=True)) for r in small]


# Periodic runs


def plain_runs(t, words=6, periods=4):
    n, out = len(t), []
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if t[i] != t[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and t[i] == t[i + q]:
                i += 1
            e = i + q
            if e - s >= max(words, periods * q) and not any(all(t[k] == t[k + p] for k in range(s, e - p)) for p in range(1, q)):
                out.append((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def runny(rng):
    k = rng.choice([1, 2, 3, 5, 40])
    t = [rng.randrange(k) for _ in range(rng.randrange(50))]
    for _ in range(rng.randrange(4)):
        unit = [rng.randrange(k) for _ in range(rng.randint(1, 6))]
        at = rng.randint(0, len(t))
        t[at:at] = unit * rng.randint(1, 8) + unit[: rng.randint(0, len(unit))]
    return t


def test_runs_match_brute_force():
    rng = random.Random(2)
    for _ in range(400):
        texts = [runny(rng) for _ in range(rng.randint(1, 5))]
        assert runs_of([np.array(t, dtype=np.int64) for t in texts]) == [plain_runs(t) for t in texts]


def test_suffix_array_and_intervals():
    rng = random.Random(4)
    for _ in range(100):
        t = [rng.randrange(1, 4) for _ in range(rng.randint(0, 40))] + [0]
        s = Suffixes(np.array(t, dtype=np.int64))
        assert s.sa.tolist() == sorted(range(len(t)), key=lambda k: t[k:])
        for k in range(1, len(t)):
            a, b = t[s.sa[k - 1] :], t[s.sa[k] :]
            assert s.lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        first, last, depth, _ = s.intervals(2)
        plain = set()
        for k in range(1, len(t)):
            if s.lcp[k]:
                low, high = k - 1, k
                while low > 0 and s.lcp[low] >= s.lcp[k]:
                    low -= 1
                while high + 1 < len(t) and s.lcp[high + 1] >= s.lcp[k]:
                    high += 1
                plain.add((low, high, int(s.lcp[k])))
        assert set(zip(first.tolist(), last.tolist(), depth.tolist(), strict=True)) == plain and len(first) == len(plain)


def digests(words):
    runs = plain_runs(words)
    gone = {k for s, n, p in runs for k in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_query_against_brute_force(spark, tmp_path):
    rng = random.Random(9)
    texts = [" ".join(f"w{x}" for x in runny(rng)) for _ in range(150)]
    texts += [None, "", " \t\n", "a", "a " * 300, "É é " * 9 + "\x85x", "x\x0by\x0cz\r" * 6, "la la la la la", "la la la la la la"]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)] + [(None, "b " * 8, 1), (3, "c " * 8, 1)], "doc_id long, text string, runs int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter((r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect())
    expected = Counter()
    for r in docs.collect():
        words = (r.text or "").encode().split()
        h, n = zlib.crc32(str(r.doc_id).encode()) if r.doc_id is not None else 1, len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        expected[(r.doc_id, *digests(words))] += 1
    assert got == expected
    assert sum(k[1] > 0 for k in expected) > 60


def test_runs_in_small_blocks_and_of_no_rows(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = sorted(map(repr, periodic_runs.periodic_runs(repeated_texts(docs)).collect()))
    monkeypatch.setattr(periodic_runs, "BLOCK_WORDS", 100)
    assert sorted(map(repr, periodic_runs.periodic_runs(repeated_texts(docs).repartition(3)).collect())) == whole
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


# Mixing


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return {**share, **fixed}
        fixed.update({s: 3 * sizes[s] for s in over})


def check_mix(spark, docs, **options):
    rows = mix(docs, keep_text=True, **options).collect()
    sizes, taken = Counter(), Counter()
    for r in rows:
        n = len((r.text or "").encode().split())
        assert r.size == n
        sizes[r.source] += n
        taken[r.source] += sum(d.words for d in r.draws)
        assert sum(d.words for d in r.draws) <= 3 * n and len({d.epoch for d in r.draws}) == len(r.draws)
    targets = plain_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 1
    return rows


def test_mix_of_the_test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("size", F.lit("clash"))
    rows = check_mix(spark, docs, shards=8)
    again = mix(docs.repartition(7), shards=8, keep_text=True).collect()
    assert Counter(map(repr, rows)) == Counter(map(repr, again))
    other = mix(docs, shards=8, seed=1, keep_text=True).collect()
    assert Counter(map(repr, rows)) != Counter(map(repr, other))


def test_mix_of_awkward_rows(spark):
    words = lambda n: " ".join(f"w{k}" for k in range(n))
    rows = [(k, words(5), "hot") for k in range(300)] + [(1000 + k, words(k), None) for k in range(20)] + [(2000, words(3), "tiny"), (2001, None, "nothing"), (2002, "", "nothing")]
    rows += [(None, words(7), "hot"), (None, words(7), "hot"), (5, words(5), "hot"), (5, words(9), "Z"), (3000, words(40_000), "long"), (3001, " \t\n", "é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check_mix(spark, docs, shards=4)
    check_mix(spark, docs, shards=1)
    assert mix(docs.limit(0)).count() == 0
    empty = mix(docs.where("source = 'nothing'")).collect()
    assert len(empty) == 2 and all(r.target == 0 and sum(d.words for d in r.draws) == 0 for r in empty)
    with pytest.raises(ValueError, match="power of two"):
        mix(docs, shards=6)


def test_many_sources_are_salted_and_numbered(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(mixing, "GROUP", 7)
    docs = spark.range(900).select("id", F.concat(F.lit("s"), F.col("id") % 50).alias("source"), F.repeat(F.lit("a b "), (F.col("id") % 9).cast("int")).alias("text")).withColumnRenamed("id", "doc_id")
    check_mix(spark, docs, shards=4)


def test_shards_have_equal_numbers_of_blocks_and_shuffled_texts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "DOCS_PER_BLOCK", 1)
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 700, "a").when(F.col("id") < 900, "b").otherwise("c").alias("source"), F.lit("one two three").alias("text"))
    found = mix(docs, shards=8, keep_text=True)
    out = mixed_shards(found).collect()
    assert sum(r.words for r in out) == 6000
    per_shard = Counter()
    for r in out:
        per_shard[r.shard] += r.words
        assert r.text == " ".join("one two three".split()[: r.words])
    assert len(per_shard) == 8 and max(per_shard.values()) < 1.5 * min(per_shard.values())
    for s in ("a", "b", "c"):  # each shard has about its share of each source
        n = Counter(d.shard for r in found.where(F.col("source") == s).collect() for d in r.draws)
        assert len(n) == 8 and max(n.values()) < 3.5 * min(n.values())
    ids = [r.doc_id for r in out if r.shard == 0]
    assert ids != sorted(ids)


def test_tree_keeps_quotas_and_draws_by_the_hypergeometric_law(spark):
    counts = [[30, 0, 5], [7, 22]]
    root = spark.createDataFrame([(counts,)], "counts array<array<long>>")
    leaves = mixing.split_quotas(root, 4).collect()
    assert np.array_equal(sum(np.array([x for g in r.counts for x in g]) for r in leaves), [30, 0, 5, 7, 22])
    assert [sum(sum(g) for g in r.counts) for r in leaves] == [16] * 4 and all(x >= 0 for r in leaves for g in r.counts for x in g)
    draws = spark.range(20_000).select(mixing.hypergeometric(F.lit(50).cast("long"), F.lit(20).cast("long"), F.lit(10).cast("long"), mixing.uniform(F.col("id"))).alias("x"))
    n = {r.x: r["count"] for r in draws.groupBy("x").count().collect()}
    from math import comb

    for k in range(11):
        p = comb(20, k) * comb(30, 10 - k) / comb(50, 10)
        assert abs(n.get(k, 0) / 20_000 - p) < 5 * (p / 20_000) ** 0.5 + 1e-4
    edge = lambda *a: spark.range(1).select(mixing.hypergeometric(*(F.lit(x).cast("long") for x in a), F.lit(0.3))).first()[0]
    assert [edge(0, 0, 0), edge(5, 5, 3), edge(5, 0, 3), edge(5, 2, 5), edge(5, 2, 0)] == [0, 3, 0, 2, 0]


def test_mix_query_gives_its_columns(spark):
    found = QUERIES["op13_mixing"](spark, SF)
    assert found.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
