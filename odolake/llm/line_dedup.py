"""Line dedup by a deletion-neighbourhood join on words.

Lines are compared by their words in lower case, so blanks do not matter. Equal lines are repeats. Lines of
``MIN_WORDS`` words or more are also repeats if one word was replaced, added or left out (word edit distance 1). The
earliest line, by document id and line number, stays; a line goes if any earlier line lies within the bound, judged
on the input.

1. Distinct lines are found by hash, without their text.
2. A line within the bound of another shares its first or its last half of words with it. Lines that share neither
   half with another line cannot have a neighbour and emit nothing.
3. The others emit a key for every deletion variant: (words, place, hash without that word). Lines that agree
   without the same place differ in that word only; a line that agrees with the variant of a longer line lacks one
   word. So all members of a key are neighbours, and the earliest is enough: no pairs within a group. The hash
   of a variant is the XOR of (word, place) hashes left and right of the gap, from running XORs: linear in the line.
4. Each line that has an earlier neighbour is checked against it word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from odolake.llm.common import stored
from odolake.llm.marks import marked, marks, with_mark
from odolake.operators.ordering import with_position

MIN_WORDS = 8
BLOCK = 256
PLACES = 1 << 23  # more than the words of a line
SAME, SHORT, LONG = 0, 1, 2  # roles of a line under a key


def _words(line: Column) -> Column:
    """Words of a line in lower case; two lines are equal if their words are."""
    low = F.lower(line)
    odd = line.rlike(r"[\t\x0B\f\r]")  # a plain split at spaces is several times as fast
    return F.array_remove(F.when(odd, F.split(low, r"\s+")).otherwise(F.split(low, " ")), "")


def _lines(docs: DataFrame) -> DataFrame:
    """Every line with its document's key (id, hash of the text) and its number."""
    hashed = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")  # before the split: once per document
    return hashed.select("doc_id", "th", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


def _half_keys(words: Column, n: Column) -> Column:
    """Keys of the first and last half, also of the halves of a line one word shorter."""

    def keys(half: Column) -> list[Column]:
        return [
            F.xxhash64(F.lit(1), half, F.slice(words, F.lit(1), half)),
            F.xxhash64(F.lit(2), half, F.slice(words, n - half + 1, half)),
        ]

    half = F.floor(n / 2).cast("int")
    # The halves of an odd line are as long as those of a line one word shorter.
    return F.when(n % 2 == 0, F.array(*keys(half), *keys(half - 1))).otherwise(F.array(*keys(half)))


def _running_xor(values: Column) -> Column:
    """XOR of the first 1, 2, 3 … values; blocks keep it linear for long lines."""

    def scan(block: Column) -> Column:
        start = F.struct(F.array().cast("array<bigint>").alias("seen"), F.lit(0).cast("bigint").alias("now"))

        def step(state: Column, value: Column) -> Column:
            now = state["now"].bitwiseXOR(value)
            return F.struct(F.array_append(state["seen"], now).alias("seen"), now.alias("now"))

        return F.aggregate(block, start, step)["seen"]

    def cut(whole: Column) -> Column:
        last = F.greatest(F.lit(0), F.floor((F.size(whole) - 1) / BLOCK)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: scan(F.slice(whole, b * BLOCK + 1, F.lit(BLOCK))))

    def join(inner: Column) -> Column:
        before = F.concat(F.array(F.lit(0).cast("bigint")), scan(F.transform(inner, lambda x: F.element_at(x, -1))))
        add = lambda x, offset: F.transform(x, lambda v: v.bitwiseXOR(offset))
        return F.flatten(F.zip_with(inner, F.slice(before, F.lit(1), F.size(inner)), add))

    return _once(_once(values, cut), join)


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _variants(texts: DataFrame) -> DataFrame:
    """Keys of every line: without each word for lines as long, and in both roles for lines one word longer.

    ``texts`` has the running XORs of the words' hashes as left (by place) and right (by the place before).
    """
    def without(i: Column) -> Column:
        before = F.when(i > 0, F.get("left", i - 1)).otherwise(F.lit(0).cast("bigint"))
        return before.bitwiseXOR(F.element_at("right", -1)).bitwiseXOR(F.get("right", i))

    def entry(key: Column, role: int, place: Column) -> Column:
        packed = F.col("spot") * PLACES + place + 1  # smaller for an earlier line
        return F.struct(key.alias("key"), F.lit(role).alias("role"), packed.alias("at"))

    places = F.sequence(F.lit(0), F.col("n") - 1)
    as_long = F.transform(places, lambda i: entry(F.xxhash64(F.lit(SAME), F.col("n"), i, without(i)), SAME, i))
    longer = F.transform(places, lambda i: entry(F.xxhash64(F.lit(SHORT), F.col("n") - 1, without(i)), LONG, i))
    itself = entry(F.xxhash64(F.lit(SHORT), F.col("n"), F.element_at("left", -1)), SHORT, F.lit(-1))
    keys = F.concat(as_long, longer, F.array(itself))
    return texts.select(F.inline(keys))


def _summed(words: Column) -> list[Column]:
    """Running XORs of (word, place) hashes, and of the hashes with each word one place earlier."""
    here = F.transform(words, lambda w, i: F.xxhash64(w, i + 1))
    shifted = F.transform(words, lambda w, i: F.xxhash64(w, i))
    return [_running_xor(here).alias("left"), _running_xor(shifted).alias("right")]


def _without(words: str, place: str) -> Column:
    whole, at = F.col(words), F.col(place)
    return F.concat(F.slice(whole, F.lit(1), at), F.slice(whole, at + 2, F.greatest(F.lit(0), F.size(whole) - at - 1)))


def _near_lines(texts: DataFrame) -> DataFrame:
    """(h1, h2) of the lines with an earlier line at word distance 1; a word-by-word check confirms each."""
    variants = _variants(texts)
    # Most keys have one line, so keys are counted alone first, and only what may have company is dealt with its roles.
    shared = variants.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    variants = stored(marked(variants, F.col("key"), marks(shared.select(F.col("key").alias("h")))), "variants")
    spot = F.col("at")
    earliest = variants.groupBy("key").agg(
        F.count(F.lit(1)).alias("k"),
        F.min(F.when(F.col("role") == SAME, spot)).alias("same"),
        F.min(F.when(F.col("role") == SHORT, spot)).alias("short"),
        F.min(F.when(F.col("role") == LONG, spot)).alias("long"),
    )
    met = variants.join(earliest.where("k > 1").drop("k"), "key")
    other = F.when(F.col("role") == SAME, F.col("same")).when(F.col("role") == SHORT, F.col("long")).otherwise(F.col("short"))
    line, place = F.expr(f"at div {PLACES}"), F.col("at") % PLACES - 1
    met = met.withColumn("other", other).withColumn("spot", line).where(F.expr(f"other div {PLACES}") < F.col("spot"))
    pairs = met.groupBy("spot").agg(F.min(F.struct("other", "role", place.alias("place"))).alias("m"))
    pairs = pairs.select(
        "spot",
        F.expr(f"m.other div {PLACES}").alias("other_spot"),
        "m.role",
        F.col("m.place").cast("int").alias("place"),
        (F.col("m.other") % PLACES - 1).cast("int").alias("other_place"),
    )
    theirs = texts.select(F.col("spot").alias("other_spot"), F.col("words").alias("other_words"))
    both = pairs.join(texts.select("spot", "h1", "h2", "words"), "spot").join(theirs, "other_spot")
    alike = (
        F.when(F.col("role") == SAME, _without("words", "place") == _without("other_words", "other_place"))
        .when(F.col("role") == SHORT, F.col("words") == _without("other_words", "other_place"))
        .otherwise(_without("words", "place") == F.col("other_words"))
    )
    return both.where(alike).select("h1", "h2")


def line_decisions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, th, line_no, exact) of every line that goes; ``th`` is the hash of the document's text."""
    words = _lines(docs).where(F.col("line").rlike(r"\S")).withColumn("words", _words(F.col("line")))
    n = F.size("words")
    cut = words.select("doc_id", "th", "line_no", "words", n.alias("n"), F.when(n >= min_words, _half_keys(F.col("words"), n)).alias("keys"))
    # A second hash of the words: the halves' hashes together where there are any, as they need no further pass.
    second = F.when(F.col("keys").isNull(), F.xxhash64(F.lit(2), "words")).otherwise(F.xxhash64("n", F.get("keys", 0), F.get("keys", 1)))
    lines = cut.select("doc_id", "th", "line_no", F.xxhash64(F.lit(1), "words").alias("h1"), second.alias("h2"), "n", "keys")
    lines = stored(lines, "lines")
    # Documents without id come last.
    spot = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "th", "line_no")
    first = lines.groupBy("h1", "h2").agg(
        F.min(spot).alias("at"), F.count(F.lit(1)).alias("k"), F.any_value("n").alias("n"), F.any_value("keys").alias("keys")
    )
    first = stored(first, "first")

    halves = first.select("h1", F.explode("keys").alias("half"))
    several = halves.groupBy("half").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("half")
    several = stored(several, "several")
    maybe = marked(halves, F.col("half"), marks(several.select(F.col("half").alias("h"))))
    maybe = maybe.join(several, "half", "left_semi").select("h1").distinct()
    wanted = first.join(maybe, "h1").groupBy(F.col("at.doc_id").alias("w_id"), F.col("at.th").alias("w_th"))
    wanted = stored(wanted.agg(F.collect_list(F.struct("h1", "h2", "at", "n")).alias("some")), "wanted")  # lines of one document
    sources = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    sources = marked(sources, F.xxhash64("doc_id", "th"), marks(wanted.select(F.xxhash64("w_id", "w_th").alias("h"))))
    sources = sources.join(wanted, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("th") == F.col("w_th")))
    cut = sources.select("some", F.split("text", "\n", -1).alias("lines"))
    texts = cut.select(
        F.inline(F.transform("some", lambda x: F.struct(
            x["h1"].alias("h1"), x["h2"].alias("h2"), x["at"].alias("at"), x["n"].alias("n"),
            _words(F.get("lines", x["at"]["line_no"])).alias("words"),
        )))
    )
    # Variants are many times as large as the few lines they come from, so spread these out first.
    texts = texts.dropDuplicates(["h1", "h2"])  # rows that repeat
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = with_position(texts.repartition(spread, "h1"), ["at"], "spot")
    texts = stored(texts.select("spot", "h1", "h2", "n", "words", *_summed(F.col("words"))), "texts")
    near = stored(_near_lines(texts), "near").withColumn("near", F.lit(True))

    # Lines that are there once and near none stay, and need no look at the first one.
    several = first.where("k > 1").select(F.col("h1").alias("h")).union(near.select("h1"))
    judged = marked(lines, F.col("h1"), marks(several)).join(first.select("h1", "h2", "at"), ["h1", "h2"]).join(near, ["h1", "h2"], "left")
    exact = spot > F.col("at")
    return judged.where(exact | F.col("near")).select("doc_id", "th", "line_no", exact.alias("exact"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with repeated lines taken out of ``text``, and a struct column ``line_dedup``.

    ``line_dedup`` holds n_lines, n_exact and n_near (lines gone as equal to, or one word from, an earlier line). A
    text keeps its other lines, joined by newlines; if none is left it is empty. Blank lines are never repeats. A
    null text stays null with 0 lines, an empty one has one blank line. Rows with the same id and text are one document, and all
    of them keep the same lines; the same text under another id is a repeat, so its lines go. Documents without id
    come last in order. All other columns come through, whatever their names; an older ``line_dedup`` is replaced.
    """
    gone = line_decisions(docs, min_words).distinct().groupBy(F.col("doc_id").alias("g_id"), F.col("th").alias("g_th"))
    gone = stored(gone.agg(F.collect_list("line_no").alias("gone"), F.count_if("exact").alias("n_exact")), "gone")
    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    key = F.xxhash64("_row.text")
    # Documents that lose no line are not shuffled.
    pages = marks(gone.select(F.xxhash64("g_id", "g_th").alias("h")))
    rows = with_mark(rows, F.xxhash64(F.col("_row.doc_id"), key), pages, "_cut")
    cut = rows.where("_cut").join(gone, F.col("_row.doc_id").eqNullSafe(F.col("g_id")) & (key == F.col("g_th")), "left")
    rows = cut.unionByName(rows.where("NOT _cut"), allowMissingColumns=True)
    newlines = F.octet_length("_row.text") - F.octet_length(F.replace("_row.text", F.lit("\n"), F.lit("")))
    lines = F.split("_row.text", "\n", -1)
    rest = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("_row.text")).otherwise(
        F.array_join(F.transform(rest, lambda i: F.get(lines, i)), "\n")
    )
    n_exact = F.coalesce("n_exact", F.lit(0)).cast("long")
    n_gone = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone"))
    counts = F.struct(
        F.coalesce(newlines + 1, F.lit(0)).cast("long").alias("n_lines"),
        n_exact.alias("n_exact"),
        (n_gone - n_exact).cast("long").alias("n_near"),
    )
    same = [c for c in docs.columns if c != "line_dedup"]
    return rows.select(
        *[text.alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in same], counts.alias("line_dedup")
    )
