"""The ten operators and the pipeline against plain versions, and on odd rows."""

import hashlib
import random
import re
import textwrap
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from odolake.llm import components, decontaminate as dec, language, licenses, line_dedup, marks, mixing, near_dedup, order_minhash, pii, repeats, toxicity
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, h1 long, line_dedup string, pii int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", 1, "y", 2) for i, t, s in rows], SCHEMA).repartition(3)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def texts():
    """Documents with copies, near copies, shared passages and repeated lines, and odd ones."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 6)))
    passage = " ".join(word() for _ in range(30))
    out = []
    for i in range(60):
        lines = [" ".join(word() for _ in range(rnd.randint(1, 25))) for _ in range(rnd.randint(1, 6))]
        if i % 4 == 0:
            lines.insert(rnd.randint(0, len(lines)), passage)
        text = "\n".join(lines)
        if i % 7 == 3:
            text = out[rnd.randrange(len(out))][1]
        if i % 7 == 5:
            other = (out[rnd.randrange(len(out))][1] or "").split(" ")
            other[len(other) // 2] = word()
            text = " ".join(other)
        out.append((i, text, rnd.choice(["s1", "s2", None, "s3"])))
    out += [(100, None, "s1"), (101, "", None), (102, " \t\n ", "s2"), (103, "ab " * 20_000, "s1"), (104, "x", "s3"), (105, "日本語" * 40, "s1")]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    return frame(spark, texts).cache()


def pairs(texts):
    return [(i, t) for i, t, _ in texts]


def test_decontaminate(spark, docs, texts):
    w = texts[1][1].split()
    items = [(7, " ".join(w[:12])), (8, texts[2][1]), (9, " ".join(texts[4][1].split()[1:4])), (10, None), (11, ""), (12, "ab ab"), (None, "x")]
    found = dec.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"))
    got = {r.row.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in found.collect()}
    want = brute.decontaminate(pairs(texts), items)
    assert got == {k: (a, b, [i for i in c if i != "None"]) for k, (a, b, c) in want.items()}


def test_near_duplicates(docs, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == brute.near_duplicates(pairs(texts))


def test_line_dedup(docs, texts):
    got = {r.doc_id: (r.line_dedup.n_lines, r.line_dedup.n_exact, r.line_dedup.n_near, r.text) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == brute.dedup_lines(pairs(texts))


def test_line_dedup_one_word(spark):
    base = "one two three four five six seven eight nine"
    rows = [(1, base), (2, base.replace("five", "FIVE!")), (3, base + " ten"), (4, base.replace("one two", "two one")), (5, "one two"), (6, "one three")]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame(spark, [(i, t, "s") for i, t in rows])).collect()}
    assert got == {1: base, 2: "", 3: "", 4: rows[3][1], 5: "one two", 6: "one three"}


def test_repeated_bytes(docs, texts):
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in repeats.repeated_bytes(docs).collect()}
    assert got == brute.repeated_spans(pairs(texts))


def test_repeated_bytes_hot_anchors(spark, docs, texts, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 3_000)  # many chunks and buckets
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 12_000)
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(7))
    phrase = "a phrase of four and twenty bytes amid text of its own"
    rows = [(i, f"{word()} {word()} {word() * (i % 5)}{phrase}{rnd.choice('xyz') * (i % 3)} {word()} {word()}", "s") for i in range(300)]
    for table, some in ((docs, pairs(texts)), (frame(spark, rows), [r[:2] for r in rows])):
        for hot_pieces in (0, 5):
            got = repeats.repeated_bytes(table, hot_pieces).collect()
            assert {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got} == brute.repeated_spans(some)


def test_hot_anchor_has_no_index():
    rnd = random.Random(4)
    phrase = "a phrase of four and twenty bytes amid text of its own"
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(30))
    texts = pa.table({"doc_id": pa.array(range(500)), "text": [f"{word()}{phrase}{word()}" for _ in range(500)]})
    key = (pa.scalar(0, pa.int32()),)
    sent = repeats._send_anchors(1)(key, texts)
    for hot_pieces, whole in ((10, False), (10**6, True)):
        reply = repeats._shared_anchors(hot_pieces)(sent)
        pieces = repeats._send_pieces(1)(key, texts, reply)
        sizes = [len(x) for x in pieces.column("anchor").to_pylist() if x]
        indexed = sum(sizes) * 8 // repeats.ANCHOR_BITS
        assert (indexed > 100) == whole and pieces.num_rows == (2 if whole else 3 if sizes else 2)


def test_order_minhash(docs, texts):
    got = {r.doc_id: r for r in order_minhash.with_edited(docs, rows_per_chunk=7).collect()}
    ordered = sorted(pairs(texts), reverse=True)
    for (key, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert (got[key].n_chars, got[key].edited_sha256) == (len(text), sha(edited))
        assert got[key].fingerprint == order_minhash.as_text(order_minhash.fingerprint(text))
        assert got[key].edited_fingerprint == order_minhash.as_text(order_minhash.fingerprint(edited))
        assert 0 <= got[key].near_next <= 1
    assert got[101].fingerprint == got[100].fingerprint


def test_order_minhash_numbers_repeats():
    assert len(set(order_minhash.kmers("ab" * 50).tolist())) == len(order_minhash.kmers("ab" * 50))


def test_mixing(docs, texts):
    rows = mixing.mix(docs, shard_docs=5).collect()
    sizes = {i: len((t or "").split()) for i, t, _ in texts}
    assert {r.doc_id: r["size"] for r in rows} == sizes
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    assert abs(sum(r.target for r in {r.source_size: r for r in rows}.values()) - sum(sizes.values())) < 1e-6 * sum(sizes.values())
    for size in {r.source_size for r in rows}:
        some = [r for r in rows if r.source_size == size]
        assert abs(sum(r.taken for r in some) - some[0].target) <= 0.02 * some[0].target + 5
    assert sorted(mixing.mix(docs, shard_docs=5).collect()) == sorted(rows)


def test_apportion_gives_highest_quotients(spark):
    rnd = random.Random(2)
    votes = [rnd.randint(1, 5000) for _ in range(40)]
    for seats in (3, 17, 400, 9999):
        quotients = sorted(((v / (2 * k + 1), -i) for i, v in enumerate(votes) for k in range(seats)), reverse=True)[:seats]
        want = [sum(1 for _, j in quotients if j == -i) for i in range(len(votes))]
        df = spark.createDataFrame([(i, v, seats) for i, v in enumerate(votes)], "p int, v long, s long")
        got = {r.p: r.n for r in mixing.apportion(df, [], "v", "s", "n", "p").collect()}
        assert [got[i] for i in range(len(votes))] == want


def test_pii(spark):
    rows = [
        (1, "mail Ann.Lee9@mail1.example.com or +1 (736) 555-2678, 4111 1111 1111 1111, 10.2.30.255!", "s"),
        (2, "ANN.LEE9@mail1.example.com and +1 736 555 2678 and 4111111111111111", "s"),
        (3, "Herr Karl Weiß met Mrs Doe; nothing in v1.2.3 or 12345", "s"),
        (4, None, "s"),
        (5, "", "s"),
    ]
    got = {r.doc_id: r for r in pii.replace_pii(frame(spark, rows)).collect()}
    one, two = got[1].text, got[2].text
    assert got[1].pii.n_entities == 4 and got[2].pii.n_entities == 3 and got[3].pii.n_entities == 2
    assert len(one) == len(rows[0][1]) and "Ann" not in one and "555-2678" not in one
    assert one.split()[1].lower() == two.split()[0].lower()
    assert [c for c in one.split(",")[0] if c.isdigit()][-10:] == [c for c in two.split(" and ")[1] if c.isdigit()][-10:]
    digits = [int(c) for c in two.split()[-1]][::-1]
    assert sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0
    assert got[3].text.endswith("; nothing in v1.2.3 or 12345") and "Karl" not in got[3].text and "Doe" not in got[3].text
    assert got[4].text is None and got[5].text == ""


def test_pii_whole_names_and_addresses(spark):
    texts = [
        "an jörg.müller@firma.de und šárka@pošta.cz, 山田@例え.jp",
        "Mrs Anne-Marie Dupont, Mr John Paul Jones, Mr O'Brien's hat, Herr von der Heide, Mr J. R. Smith went",
        "Mr Иван Петров and Mrs Ελένη Παππά went",
        "Mr John met Mr. X",
    ]
    got = {r.doc_id: r.text for r in pii.replace_pii(frame(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    for i, real in ((0, "jörg müller firma šárka pošta 山田 例え"), (1, "Anne Marie Dupont John Paul Jones Brien Heide Smith"), (2, "Иван Петров Ελένη Παππά")):
        assert not [w for w in real.split() if w in got[i]], got[i]
    assert re.fullmatch(r"an \S+@\S+\.de und \S+@\S+\.cz, \S+@\S+\.jp", got[0])
    name = r"[A-Z][a-z]+"
    wanted = rf"Mrs {name}-{name} {name}, Mr {name} {name} {name}, Mr [A-Z]'{name}'s hat, Herr von der {name}, Mr [A-Z]\. [A-Z]\. {name} went"
    assert re.fullmatch(wanted, got[1]), got[1]
    assert re.fullmatch(r"Mr [А-Я][а-я]+ [А-Я][а-я]+ and Mrs [Α-Ω][α-ως]+ [Α-Ω][α-ως]+ went", got[2]), got[2]


def test_pii_surrogates_are_distinct(spark):
    found = spark.range(150).selectExpr("'ip' AS kind", "concat_ws('.', id % 5 + 1, id div 5 % 5 + 1, id div 25, 7) AS canon")
    rows = pii.surrogates(found, "k").collect()
    assert len(rows) == 150 == len({r.made for r in rows})
    assert not {r.made for r in rows} & {r.canon for r in rows}


def test_licenses(spark):
    rows = [
        (1, "Some words.\nLicensed under CC BY-NC 4.0.\nmore", "s"),
        (2, "Licensed under the Apache License, Version 2.0.", "s"),
        (3, "This work is licensed under the GNU General Public License, version 2.", "s"),
        (4, "a driver had a licence to drive", "s"),
        (5, None, "s"),
        (6, "nothing", "s"),
    ]
    got = {r.doc_id: (r.license, r.confirmed, r.start) for r in licenses.scan_licenses(frame(spark, rows)).collect()}
    assert got[1] == ("CC-BY-NC-4.0", True, 12) and got[2] == ("Apache-2.0", True, 0) and got[3] == ("GPL-2.0", True, 0)
    assert not got[4][1] and set(got) == {1, 2, 3, 4}


def license_rows(spark, texts):
    found = licenses.scan_licenses(frame(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()
    return [sorted((r.start, r.license) for r in found if r.doc_id == i and r.confirmed) for i in range(len(texts))]


def test_licenses_in_long_lines(spark):
    known = licenses.TEMPLATES
    prose = "The river ran over green stones and nobody walked there until the evening came. " * 30
    texts = [prose + known[name] + " " + prose for name in known if "{}" not in known[name]]
    texts += ["Released under the MIT License. Licensed under CC BY 4.0.", prose + known["GPL-2.0"] + " " + known["MIT-text"] + " " + prose]
    texts += ["Copyright (c) 2020 A, 2021 B. All rights reserved. © 2022 C. All rights reserved.", "the license of " * 200 + known["MIT"]]
    got = license_rows(spark, texts)
    n = len(texts) - 4
    want = [[(len(prose), name)] for name in known if "{}" not in known[name]]
    assert got[:n] == want
    assert got[n] == [(0, "MIT"), (32, "CC-BY-4.0")]
    assert got[n + 1] == [(len(prose), "GPL-2.0"), (len(prose) + len(known["GPL-2.0"]) + 1, "MIT-text")]
    assert got[n + 2] == [(0, "Proprietary"), (51, "Proprietary-sign")] and got[n + 3] == [(3000, "MIT")]
    near = prose + known["MIT-text"].replace("merge", "munge") + " " + prose
    (row,) = licenses.scan_licenses(frame(spark, [(1, near, "s")])).collect()
    assert (row.license, row.confirmed, row.missing, row.extra) == ("MIT-text", False, 1, 1)


def test_every_template_has_a_mention(spark):
    """Each wording alone is a candidate and is found."""
    known = [name for name in licenses.TEMPLATES if "{}" not in licenses.TEMPLATES[name]]
    assert license_rows(spark, [licenses.TEMPLATES[name] for name in known]) == [[(0, name)] for name in known]


def test_licenses_wrapped(spark):
    known = licenses.TEMPLATES
    wrapped = lambda name, sign: "\n".join(sign + line for line in textwrap.wrap(known[name], 40))
    names = ["MIT-text", "BSD-text", "GPL-2.0", "Apache-2.0-notice", "Unlicense"]
    for sign in ("", "# ", " * ", "// ", "dnl "):
        texts = [f"some words\n{wrapped(name, sign)}\nother words" for name in names]
        assert license_rows(spark, texts) == [[(11 + len(sign), name)] for name in names]
    assert license_rows(spark, ["released into the\n\npublic domain"]) == [[]]


def test_licenses_are_confirmed_through_compression(monkeypatch):
    """A place counts only if the template saves enough of its window; every wording does so by far."""
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name, parts in scanner.parts:
        assert scanner.reduction(name, licenses._joined(parts)) > 1.5 * licenses.MIN_REDUCTION
    text = "a b. Copyright 2020 all of us. All rights reserved. " + licenses.TEMPLATES["GPL-2.0"]
    assert [(r[1], r[-1]) for r in scanner.judge(text)] == [("Proprietary", True), ("GPL-2.0", True)]
    monkeypatch.setattr(licenses, "MIN_REDUCTION", 9)
    assert not any(r[-1] for r in licenses.Scanner(licenses.TEMPLATES).judge(text))


def test_license_places_equal_a_plain_search():
    """Places of templates with and without parts that differ, in random words."""
    rnd = random.Random(8)
    known = {"one": "a b a", "two": "c {} a b", "three": "b {} c {} d"}
    scanner = licenses.Scanner(known)
    for _ in range(300):
        own = [rnd.choice("abcd") for _ in range(rnd.randint(1, 14))]
        for name, parts in scanner.parts:
            pattern = ".*?".join(re.escape("".join(p)) for p in parts)
            ends, begin = [], 0
            while found := re.compile(pattern).search("".join(own), begin):
                begin = found.end()
                ends.append(begin)
            got, begin = [], 0
            for starts in licenses._aligned(parts, {w: [i for i, x in enumerate(own) if x == w] for w in own}):
                if starts[0] >= begin and [own[c : c + len(p)] for c, p in zip(starts, parts)] == parts:
                    begin = starts[-1] + len(parts[-1])
                    got.append(begin)
            assert got == ends


def test_language(spark):
    de, en = "der hund und die katze sind nicht hier ", "the dog and the cat are not here "
    train = spark.createDataFrame([(de * 9, "de"), (en * 9, "en"), (None, "en"), (en, None)], "text string, lang string")
    found = language.predict(
        frame(spark, [(1, "die katze und der hund", "s"), (2, "THE CAT and the dog!", "s"), (3, None, "s"), (4, "12 !", "s")]),
        language.prototypes(train),
    )
    got = {r.doc_id: r.lang_pred for r in found.collect()}
    assert got == {1: "de", 2: "en", 3: "und", 4: "und"}


def test_language_beyond_the_basic_plane(spark):
    gothic = "𐌰𐌱𐌲 𐌳𐌴𐌵 "
    train = spark.createDataFrame([(gothic * 9 + "😀🎉 " * 50, "got"), ("the dog and the cat 😀 " * 9, "en")], "text string, lang string")
    found = language.predict(frame(spark, [(1, "😀🎉 😀", "s"), (2, gothic, "s"), (3, "the cat 🎉🎉🎉🎉", "s")]), language.prototypes(train))
    assert {r.doc_id: r.lang_pred for r in found.collect()} == {1: "und", 2: "got", 3: "en"}


def test_toxicity(spark):
    rnd = random.Random(3)
    words = ["tree", "river", "stone", "cloud", "you", "walk", "house", "green", "road"]
    rows = []
    for i in range(400):
        some = [rnd.choice(words) for _ in range(30)]
        if i % 5 == 0:
            some[rnd.randrange(30)] = rnd.choice(["nastyword", "vilething", "vilestuff"])
        rows.append((i, " ".join(some), int(i % 5 == 0)))
    train = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(train, rounds=4)
    fresh = [(1, "you are a vilething on the road", "s"), (2, "you walk on the road", "s"), (3, None, "s"), (4, "", "s")]
    got = {r.row.doc_id: r.score for r in model.score(frame(spark, fresh)).collect()}
    assert got[1] >= 0.5 > max(got[2], got[3], got[4]) and all(0 <= s <= 1 for s in got.values())
    assert toxicity.fit(train.where("toxic = 0")).trees is None


def test_empty_tables(spark, docs):
    none = docs.where("false")
    items = spark.createDataFrame([], "item_id long, text string")
    assert dec.decontaminate(docs, items).where("n_hit > 0").isEmpty()
    for made in (
        dec.decontaminate(none, items), near_dedup.near_duplicates(none), line_dedup.dedup_lines(none), repeats.repeated_bytes(none),
        order_minhash.with_edited(none), mixing.mix(none), pii.replace_pii(none), licenses.scan_licenses(none), language.predict(none, {}),
    ):
        assert made.isEmpty()


def test_repeated_rows_and_missing_ids(spark, texts):
    rows = [(1, texts[0][1], "a"), (1, texts[0][1], "a"), (None, texts[0][1], "b"), (None, "short", None), (2, texts[1][1], "a")]
    odd = frame(spark, rows)
    for made in (near_dedup.near_duplicates(odd), line_dedup.dedup_lines(odd), repeats.repeated_bytes(odd), order_minhash.with_edited(odd), mixing.mix(odd), pii.replace_pii(odd)):
        assert made.count() == len(rows)


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[1:]:
        before = docs.select("doc_id", "text", "source").collect()
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "stage")
        kept = {r.doc_id: r.text for r in docs.collect()}
        pairs_ = [(r.doc_id, r.text) for r in before]
        if name == "line dedup":
            want = {k: v[3] for k, v in brute.dedup_lines(pairs_).items() if v[3].strip()}
        elif name == "near-duplicates":
            want = {k: dict(pairs_)[k] for k, v in brute.near_duplicates(pairs_, corpus_pipeline.NEAR_PERCENT).items() if v[1] == k}
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
            want = {k: dict(pairs_)[k] for k, v in brute.decontaminate(pairs_, items).items() if not v[1]}
        else:
            assert set(kept) <= {r.doc_id for r in before} and {"taken", "target"} <= set(docs.columns)
            continue
        assert kept == want
        assert docs.columns == columns


def test_near_duplicates_at_80(spark, sf_dir):
    assert near_dedup.limits(85) == (85, 32, 203) and near_dedup.limits(80).sketch > 203
    with pytest.raises(ValueError):
        near_dedup.limits(60)
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    rows = []
    for i in range(120):
        if i % 2 == 0:
            own = [word() for _ in range(150)]
        else:  # words changed at the end, so that 1 to 40 shingles differ
            own = own[: len(own) - rnd.randint(1, 40)] + [word() for _ in range(rnd.randint(0, 4))]
        rows.append((i, " ".join(own), "s"))
    sets = {i: brute.shingles(t) for i, t, _ in rows}
    similar = {i: len(sets[i - 1] & sets[i]) / len(sets[i - 1] | sets[i]) for i in range(1, 120, 2)}
    assert sum(0.8 <= s < 0.85 for s in similar.values()) >= 5 and min(similar.values()) < 0.8
    for percent, kept in (
        (80, corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows), sf_dir)),
        (85, near_dedup.near_duplicates(frame(spark, rows)).where("kept")),
    ):
        assert {r.doc_id for r in kept.collect()} == {i for i in sets if i % 2 == 0 or similar[i] * 100 < percent}


def test_pipeline_rejects_toxic(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    clean = labels.where("toxic = 0").select("doc_id")
    assert kept.columns == docs.columns
    assert kept.join(clean, "doc_id", "left_semi").count() >= 0.98 * clean.count()


def test_near_duplicates_of_a_crowd_below_the_threshold(spark):
    """400 texts made from one, many of them just below the least similarity to it and to each other, some in pairs."""
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    base, rows, own = [word() for _ in range(200)], [], []
    for i in range(400):
        if i % 8 == 7:  # close to the text before, wherever that lies
            own = list(own)
            own[rnd.randrange(200)] = word()
        else:
            own = list(base)
            for at in rnd.sample(range(200), rnd.choice([1, 2, 3, 5, 6, 7, 8])):
                own[at] = word()
        rows.append((i, " ".join(own), "s"))
    want = brute.near_duplicates(pairs(rows))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    groups = {}
    for key, (_, label) in want.items():
        groups.setdefault(label, []).append(key)
    assert len(groups) > 30 and max(map(len, groups.values())) > 100
    links = [(a, b) for some in groups.values() for a, b in zip(some, some[1:])]
    found = sum(got[a][1] == got[b][1] for a, b in links)
    assert found >= 0.98 * len(links)
    assert all(want[key][1] == want[label][1] for key, (_, label) in got.items())  # no link too many


@pytest.mark.parametrize("rounds, percent", [(0, 85), (0, 80), (2, 85)])
def test_near_duplicates_lose_no_link_in_crowded_buckets(spark, monkeypatch, rounds, percent):
    """Every link is found, also by the exact way alone, among texts of one origin that are cut, changed and chained."""
    monkeypatch.setattr(near_dedup, "QUIET", rounds)
    rnd = random.Random(31)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    base, rows, own = [word() for _ in range(150)], [], []
    for i in range(300):
        if i % 5 == 4:  # one word from the text before
            own = list(own)
            own[rnd.randrange(len(own))] = word()
        else:
            own = list(base)
            for at in rnd.sample(range(150), rnd.choice([2, 3, 4, 5, 6])):
                own[at] = word()
            own = own[: 150 - rnd.choice([0, 0, 6, 15, 25])]
        rows.append((i, " ".join(own), "s"))
    want = brute.near_duplicates(pairs(rows), percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame(spark, rows), percent).collect()}
    assert 20 < len({label for _, label in want.values()}) < 280
    assert got == want


def test_beginnings_of_sets_hold_every_link(spark):
    """The join on rare shingles meets all similar sets of different labels, also where one label has most of the sets."""
    rnd = random.Random(32)
    rows = []
    for node in range(160):
        some = set(range(rnd.choice([1, 5, 40, 41, 60])))
        some = {x for x in some if rnd.random() > 0.05} | {1000 * node + 500 + x for x in range(rnd.choice([0, 0, 1, 3, 5]))}
        rows.append((node, rnd.choice([0, 0, 0, node]), sorted(some or {7})))
    given = spark.createDataFrame(rows, "node long, label long, shingles array<long>")
    for percent in (85, 80, 100):
        found = near_dedup._rest(given.select("node", "label"), given.select("node", "shingles"), percent).collect()
        found = {(r.a, r.b) for r in found}
        want = set()
        for a, p, x in rows:
            for b, q, y in rows[:a]:
                if p != q and 100 * len(set(x) & set(y)) >= percent * len(set(x) | set(y)):
                    want.add((b, a))
        assert len(want) > 20 and want <= found and len(found) < 4 * len(want)


def test_near_duplicate_stage_reads_texts_once(spark, sf_dir, monkeypatch):
    """The stage loses no link in crowded buckets, and the number of its rounds does not multiply the reading of texts."""
    calls = []
    monkeypatch.setattr(near_dedup, "QUIET", 1)
    monkeypatch.setattr(near_dedup, "marked", lambda df, h, pages, own=near_dedup.marked: calls.append(1) or own(df, h, pages))
    rnd = random.Random(33)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(120):
        own = list(base)
        for at in rnd.sample(range(120), rnd.choice([1, 2, 3, 4, 5])):
            own[at] = f"x{i % 40}" if i % 3 else f"y{i}"
        rows.append((i, " ".join(own), "s"))
    want = brute.near_duplicates(pairs(rows), corpus_pipeline.NEAR_PERCENT)
    kept = corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows), sf_dir)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, (_, label) in want.items() if k == label)
    assert len(calls) == 1


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates_without_a_common_bucket(spark, monkeypatch, percent):
    """One band only: about half of the similar texts share no bucket. Their links are found all the same."""
    monkeypatch.setattr(near_dedup, "limits", lambda percent, own=near_dedup.limits: own(percent)._replace(bands=1))
    rnd = random.Random(34)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    common, rows = [word() for _ in range(30)], []
    for i in range(200):
        if i % 2 == 0:
            own = [word() for _ in range(rnd.choice([3, 12, 60, 150]))] + common * (i % 3 == 0)
        else:
            own = own + [word() for _ in range(rnd.randint(0, len(own) // 3))]
        rows.append((i, " ".join(own), "s"))
    want = brute.near_duplicates(pairs(rows), percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame(spark, rows), percent).collect()}
    assert 110 < len({label for _, label in want.values()}) < 190
    assert got == want


def test_near_duplicates_move_few_rows_of_texts_without_partner(spark, monkeypatch):
    """Also where bitmaps are full, only texts that meet another component go on, and of their sets those a link leaves room for."""
    rows_of = {}

    def stored(df, purpose, own=near_dedup.stored):
        made = own(df, purpose)
        rows_of.setdefault(purpose, []).append(made.count())
        return made

    monkeypatch.setattr(near_dedup, "stored", stored)
    monkeypatch.setattr(marks, "SPOTS", 64)
    rnd = random.Random(35)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    rows = [(i, " ".join(word() for _ in range(100)), "s") for i in range(150)]
    for i in range(10):  # three quarters of a text: no link, but more in common than its beginning has to have
        rows.append((200 + i, " ".join(rows[i][1].split()[:70] + [word() for _ in range(30)]), "s"))
    rows += [(300 + i, rows[20 + i][1] + " end", "s") for i in range(5)] + [(400, rows[30][1], "s"), (20, rows[20][1], "s")]
    want = brute.near_duplicates(pairs(rows))
    got = near_dedup.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows) and {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert rows_of.pop("signed") == [len(rows)] and rows_of.pop("strangers")[0] <= 30
    assert rows_of.pop("kin") == [0]
    # A full bitmap lets all pass that it is a filter for; what is joined after it is exact.
    assert max(rows_of["light"] + rows_of["sets"] + rows_of["met"]) <= 200 + 32 * 10


@pytest.mark.parametrize("percent", [85, 80, 100])
def test_kin_have_room_for_a_link(spark, percent):
    rnd = random.Random(36)
    rows = []
    for node in range(120):
        n = rnd.choice([1, 2, 10, 40])
        rows.append((node, sorted({rnd.randrange(60) if rnd.random() > rnd.choice([0, 0.1, 0.2]) else 1000 * (node + 1) + x for x in range(n)})))
    given = spark.createDataFrame([(node, node % 50, some) for node, some in rows], "node long, label long, shingles array<long>")
    held = Counter(x for _, some in rows for x in some)
    want = {node for node, some in rows if sum(held[x] == 1 for x in some) <= len(some) - -(-len(some) * percent // 100)}
    got = near_dedup._kin(given.select("node", "label"), given.select("node", "shingles"), percent).collect()
    assert 0 < len(want) < 120
    assert sorted((r.node, r.label) for r in got) == sorted((node, node % 50) for node in want)


def test_near_duplicates_take_few_steps(spark, monkeypatch):
    """Two nodes of a bucket have their turn in one round, bitmaps of one use are not written, and pairs need no round for labels."""
    steps = []
    own = near_dedup.stored
    for module in (near_dedup, marks, components):
        monkeypatch.setattr(module, "stored", lambda df, purpose: steps.append(purpose) or own(df, purpose))
    rnd = random.Random(37)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    base, rows = [word() for _ in range(150)], []
    for i in range(60):
        mine = list(base)
        for at in rnd.sample(range(150), rnd.choice([1, 3, 6, 7])):
            mine[at] = word()
        rows.append((i, " ".join(mine), "s"))
    want = brute.near_duplicates(pairs(rows))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert got == want and 1 < len({label for _, label in want.values()}) < 60
    turns = steps.count("hubs") - 1  # the first are those that all are compared with
    assert turns >= 1 and steps.count("marks") == 1 and steps.count("spots") == steps.count("links") == 0
    assert turns <= steps.count("open")  # only the last round is without a new link


@pytest.mark.parametrize("links, rounds", [([(9, 2), (5, 4), (2, 9)], 0), ([(i, i + 1) for i in range(40)] + [(70, 60)], 6), ([(i, 50) for i in range(50)], 1), ([], 0)])
def test_components_end_when_links_agree(spark, monkeypatch, links, rounds):
    steps = []
    own = components.stored
    monkeypatch.setattr(components, "stored", lambda df, purpose: steps.append(purpose) or own(df, purpose))
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {x: x for link in links for x in link}
    for _ in links:
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
    assert got == want
    assert len(steps) <= 1 + rounds


def test_near_duplicates_of_rows_without_id(spark):
    """A set that only rows without id have is compared too, and the links of others go through it."""
    words = [f"w{i}" for i in range(100)]
    cut = lambda a, b: " ".join(words[a:b])
    rows = [(7, cut(0, 90), "s"), (None, cut(0, 100), "s"), (9, cut(10, 100), "s"), (None, "nothing like the others at all", "s"), (3, None, "s")]
    assert brute.near_duplicates([(7, rows[0][1]), (9, rows[2][1])])[9][1] == 9
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert got == {(7, 86): (7, True), (None, 96): (7, False), (9, 86): (7, False), (None, 2): (None, True), (3, 0): (3, True)}


def test_toxicity_counts_cover_all_rows(spark, monkeypatch):
    """Counts per word and beginning equal plain ones, also when tasks hand them on early; the sample does not bound them."""
    monkeypatch.setattr(toxicity, "HELD", 20)
    rnd = random.Random(6)
    words = ["tree", "rivers", "stones", "vilething", "you", "nastyword"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 9))), int(i % 3 == 0)) for i in range(200)]
    train = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    hashes = {w: [h[0] for h in toxicity._hashes(pa.array([w]))[0]] for w in words}
    want = {}
    for _, text, toxic in rows:
        for kind_no, kind in enumerate(toxicity.KINDS):
            for value in {hashes[w][kind_no] for w in text.split()} - {0}:
                bad, every = want.get((kind, int(value.view("int64"))), (0, 0))
                want[kind, int(value.view("int64"))] = (bad + toxic, every + 1)
    got = toxicity.word_counts(train).collect()
    assert {(r.kind, r.hash): (r.bad, r.every) for r in got} == want


def test_toxicity_features_of_plain_texts():
    lexicon = {kind: toxicity._hashes(pa.array(["vile"]))[0][i] for i, kind in enumerate(toxicity.KINDS) if kind == 0}
    lexicon |= {kind: lexicon[0][:0] for kind in toxicity.KINDS[1:]}
    text = "You ARE v1le, vile!! soooo *"
    (row,) = toxicity.measure(pa.array([text]), lexicon)
    got = dict(zip(toxicity.FEATURES, row))
    n = len(text)
    assert got["lexicon_0"] == 2 / 6 and got["second_person"] == 1 / 6 and got["second_person_near"] == 2 / 6
    assert got["capitals"] == 4 / n and got["capital_words"] == 2 / n and got["exclamations"] == 2 / n
    assert got["stars"] == 1 / n and got["swapped"] == 1 / 6 and got["repeated"] == 2 / n
    assert got["punctuation"] == 4 / n and got["plain_hits"] == pytest.approx(0.6931, abs=1e-4)


def test_toxicity_of_odd_tables(spark):
    rows = [(i, ("vilething you " if i % 4 == 0 else "green tree ") * 3, i % 4 == 0) for i in range(80)]
    docs = frame(spark, [(i, t, "s") for i, t, _ in rows] + [(200, None, "s"), (201, "", None), (202, "tree " * 60_000, "s"), (None, "tree", "s")] * 2)
    labels = spark.createDataFrame([(i, int(bad)) for i, _, bad in rows] * 2 + [(None, 1), (3, None), (999, 1)], "doc_id long, toxic int")
    train = toxicity.labelled_texts(docs, labels)
    assert train.count() == 80
    scores = toxicity.fit(train, rounds=3).score(docs).select("row.doc_id", "row.row", "score").collect()
    assert len(scores) == docs.count() and {r.row for r in scores} == {"x"}
    assert all((r.score >= 0.5) == (r.doc_id is not None and r.doc_id < 80 and r.doc_id % 4 == 0) for r in scores)
    none = labels.where("false")
    model = toxicity.fit(toxicity.labelled_texts(docs, none))
    assert model.trees is None and {r.score for r in model.score(docs).collect()} == {0.0}
    assert toxicity.fit(train, rounds=3).score(docs.where("false")).isEmpty()


def test_pipeline_of_odd_rows(spark, sf_dir, texts, tmp_path):
    """Null, empty, repeated and very long texts, rows without id, own columns of clashing names, and empty tables."""
    columns = "doc_id long, text string, lang string, source string, n_chars long, line_dedup string, size int, taken int, score double"
    rows = [(i, t, "en", s, len(t or ""), "own", 1, 2, 0.5) for i, t, s in texts]
    rows += rows[:3] + [(None, "a text without id", None, None, 17, "own", 1, 2, 0.5)] * 2 + [(500, "long words " * 30_000, "en", "s1", 0, "own", 1, 2, 0.5)]
    folder = str(tmp_path / "odd")
    spark.createDataFrame(rows, columns).repartition(3).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = corpus_pipeline.run(spark, folder)
    assert set(docs.columns) | {"source_size", "target"} == set(found.columns)
    kept = found.collect()
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and set(ids) <= {r[0] for r in rows}
    assert {r.line_dedup for r in kept} == {"own"} and {r.score for r in kept} == {0.5}
    assert all(r.taken > 0 and r["size"] > 0 for r in kept) and 500 in ids

    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns, name
    none = str(tmp_path / "none")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").where("false").write.parquet(f"{none}/{name}.parquet")
    assert corpus_pipeline.run(spark, none).isEmpty()
