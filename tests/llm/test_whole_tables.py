"""Shards, manifest and divergence audit against plain versions, and on odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from odolake.llm import divergence, marks, merkle, sharding
from odolake.llm.queries import ORACLES, QUERIES
from tests.llm import brute
from tests.test_oracles import duck, plain  # noqa: F401

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, shard string, tree int, row string, term string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z", 2) for r in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def rows():
    """Documents with a text of very many copies, a hot source, odd texts and missing fields."""
    rnd = random.Random(7)
    words = ["river", "Stone", "água", "日本", "WALK", "green", "cloud"] + [f"w{chr(97 + i)}" for i in range(26)]
    text = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 40))).replace(" w", "\nw", rnd.randint(0, 2))
    out = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "", None, "ab", "é"])
        lang = rnd.choice(["en", "en", "fr", "", None])
        out.append((i, source, lang, rnd.choice([None, i]), "copied text\nof many" if i % 3 == 1 else text()))
    out += [(900, "a", "xx", 3, None), (901, "b", "xx", 0, ""), (902, None, "en", 1, "long ära\n" * 30_000), (903, "solo", "yy", 1, "one")]
    return out


@pytest.mark.parametrize("range_rows", [16_384, 8])
def test_shards(spark, rows, range_rows):
    for shards in (16, 5):
        found = sharding.shard_rows(frame(spark, rows), shards, ["doc_id"], range_rows)
        got = [(r.row.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in found.collect()]
        assert sorted(got) == sorted(brute.shard_rows([(r[0], r[4]) for r in rows], shards))


def test_shards_keep_small_groups_and_cut_large_ones(spark):
    texts = [f"text number {i // 2} of a pair" for i in range(2000)] + ["copy of one text, again"] * 1000
    docs = frame(spark, [(i, "s", "en", 0, t) for i, t in enumerate(texts)])
    found = sharding.shard_rows(docs, 16, ["doc_id", "text"], 64)
    sums = found.groupBy("shard").agg(F.sum("size").alias("n"), F.count("*").alias("rows"), F.max("slot").alias("last")).collect()
    even = sum(r.n for r in sums) / 16
    assert len(sums) == 16 and all(abs(r.n - even) <= 0.04 * even and r.last == r.rows - 1 for r in sums)
    split = found.groupBy("row.text").agg(F.countDistinct("shard").alias("n")).where("n > 1").collect()
    assert [r.text for r in split] == ["copy of one text, again"] and split[0].n >= 5


def test_shards_repeated_rows_and_ids(spark, tmp_path):
    rows = [(1, "s", "en", 0, "same")] * 40 + [(None, "s", "en", 0, None)] * 3 + [(None, None, None, None, "same")] * 3
    docs = frame(spark, rows)
    found = sharding.shard_rows(docs, 4, range_rows=4)
    got = [(r.row.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in found.collect()]
    key = lambda r: tuple((v is not None, v or 0) for v in r)
    assert sorted(got, key=key) == sorted(brute.shard_rows([(r[0], r[4]) for r in rows], 4), key=key)
    sharding.write_shards(found, str(tmp_path / "out"), 5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 46 and back.select("row.*").columns == docs.columns


@pytest.mark.parametrize("height", [7, 1, 2])
def test_manifest(spark, rows, height):
    docs = frame(spark, rows)
    cut = merkle.leaf([F.replace(c, F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in merkle.LEAF_FIELDS])
    whole = merkle.leaf([F.col(c) for c in merkle.LEAF_FIELDS])
    shown = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, cut).otherwise(whole)
    found = merkle.manifest(docs.withColumn("shown", shown), ["doc_id", "shown"], height)
    folded = merkle.fold(F.col("row.shown"), F.col("path"))
    proof = F.sha2(merkle.siblings(F.col("path")), 256)
    got = found.select("row.doc_id", "leaf", "subroot", "root", proof, folded, folded == F.col("root")).collect()
    assert sorted(tuple(r) for r in got) == brute.manifest([r[:5] for r in rows])
    assert found.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).isEmpty()


def test_witness_grows_with_later_siblings():
    leaves = [brute._digest(str(i)) for i in range(11)]
    for n in range(1, 12):
        tree = merkle.Frontier(merkle.height_of(n))
        for digest in leaves[:n]:
            tree.append(digest)
        levels = brute._tree(leaves[:n])
        assert tree.close() == levels[-1][0]
        for at, witness in enumerate(tree.witnesses):
            assert "".join(left + right for left, right in witness) == brute._climb(levels, at, leaves[at])[1]


def test_manifest_of_repeated_rows_and_ids(spark):
    rows = [(1, "s", "en", 0, "same")] * 4 + [(1, "s", "en", 0, "other"), (None, "s", None, None, None), (None, "s", None, None, "x")]
    found = merkle.manifest(frame(spark, rows), height=1).collect()
    assert len(found) == 7 and [r.pos for r in sorted(found, key=lambda r: (r.row.doc_id or 0, r.leaf, r.pos))] == list(range(7))
    assert len({r.root for r in found}) == 1 and all(r.row.shard == "x" and r["count"] == 7 for r in found)


@pytest.mark.parametrize("held", [200_000, 3])
def test_divergence(spark, rows, held, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    some = rows + rows[:9]  # repeated rows
    got = sorted(tuple(r) for r in divergence.audit(frame(spark, some)).collect())
    assert got == brute.divergence([(r[4], r[2], r[1]) for r in some])
    short = sorted(tuple(r) for r in divergence.audit(frame(spark, some), top=3).collect())
    assert short == brute.divergence([(r[4], r[2], r[1]) for r in some], 3)


def test_collapse_counts_copies(spark, rows):
    found = divergence.collapse(frame(spark, rows)).collect()
    texts = {(r[2] or "", r[4] or "") for r in rows}
    assert sorted((r.lang, r.text) for r in found) == sorted(texts)
    assert sum(c.n for r in found for c in r.copies) == len(rows)


def test_shares_of_large_counts(spark):
    big = spark.createDataFrame([(10**15, 3 * 10**15, 10**8)], "c long, n long, v long")
    (row,) = big.select(divergence.share("c", "n", "v").alias("p")).collect()
    assert row.p == 1 + 10**9 * (10**15 + 1) // (3 * 10**15 + 10**8)


def test_empty_tables(spark, rows):
    none = frame(spark, rows).where("false")
    for made in (sharding.shard_rows(none), merkle.manifest(none), divergence.audit(none)):
        assert made.isEmpty()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, duck, name):  # noqa: F811
    found = QUERIES[name](spark, sf_dir)
    cols = sorted(found.columns)
    ours = sorted(([plain(row[c]) for c in cols] for row in found.collect()), key=str)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    at = [names.index(c) for c in cols]
    assert sorted(names) == cols
    assert ours == sorted(([plain(row[i]) for i in at] for row in cursor.fetchall()), key=str)


def test_marks_never_lose_a_partner(spark, monkeypatch):
    """Every hash of the set is marked, whatever its sign; with few spots others are marked too, with many hardly any."""
    some = spark.range(-500, 500).select((F.xxhash64("id")).alias("h"))
    rows = spark.range(-500, 5000).select("id", F.when(F.col("id") < 4900, F.xxhash64("id")).alias("h"))
    for spots in (marks.SPOTS, 1 << 15):
        monkeypatch.setattr(marks, "SPOTS", spots)
        found = marks.with_mark(rows, F.col("h"), marks.marks(some), "seen")
        assert found.count() == 5500 and found.where("id < 500 AND NOT seen").isEmpty()
        assert found.where("h IS NULL AND seen").isEmpty()
        others = found.where("id >= 500 AND seen").count()
        assert others < 5 if spots == 1 << 26 else others < 400
    assert marks.marked(rows, F.col("h"), marks.marks(some.where("false"))).isEmpty()
