"""Surrogates for personal data: detected entities get keyed, type-consistent replacements.

Detection and replacement are SQL expressions. An entity is a type and a canonical form (mail addresses in lower case,
numbers without separators), so that all its mentions share one surrogate. A surrogate keeps the form: digits become
digits, letters become letters of the same script and case, and separators stay; card numbers keep a valid check
digit, addresses of hosts stay in range, and names after a title keep the title's gender. It is derived from a keyed
hash. Surrogates that meet each other or a real entity are derived again with the next attempt number, until all are
distinct; the earliest entity keeps its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from odolake.llm.common import stored

LETTER = r"\p{L}\p{M}\p{N}_"
# A word of a name, or an initial before another one. Words of nobility and the like stand within a name in small letters.
NAME = r"(?:\p{Lu}\.(?= ?\p{Lu})|\p{Lu}[\p{L}\p{M}]*(?:(?:['’]\p{Lu}|-\p{L})[\p{L}\p{M}]*)*)"
WITHIN = ("von", "van", "zu", "der", "den", "de", "del", "della", "di", "da", "dos", "du", "la", "le", "ter", "bin", "al", "y")
_SMALL = "(?:(?:" + "|".join(WITHIN) + ") ){0,3}"
_NAME = rf"{_SMALL}{NAME}(?: ?(?<=[ .]){_SMALL}{NAME})*"
# Patterns by type, tried in this order at each place. An address is looked for only where its characters
# begin (or the last mention ended), and the title of a name only before a letter a name begins with; the first character is tested first. Long texts stay linear.
PATTERNS = {
    "email": rf"(?:\G|(?<![{LETTER}.+-]))[{LETTER}.+-]*[{LETTER}]@[{LETTER}-]+(?:\.[{LETTER}-]+)+",
    "iban": r"(?=[A-Z])\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "secret": r"(?=A)\bAKIA[A-Z0-9]{16}\b",
    "ip": r"(?=\d)(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\d]|\.\d)",
    "ssn": r"(?=\d)(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?=\d)(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "phone": r"(?=[+(\d])(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?!\d)|(?=\+)(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){3,5}(?!\d)",
    "man": r"(?=[\p{Lu}abdltvyz])(?<= )(?<=\b(?:Mr|Herr|Monsieur|Señor)\b\.? )" + _NAME,
    "woman": r"(?=[\p{Lu}abdltvyz])(?<= )(?<=\b(?:Mrs|Ms|Frau|Madame|Señora)\b\.? )" + _NAME,
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# By script: pattern, consonants, vowels, what precedes an ending, endings of men's and women's names. Latin for all others.
SCRIPTS = (
    (r"\p{IsCyrillic}", "бвгдзклмнпрст", "аеиоу", "н", ("ий", "ор", "ад", "ей"), ("а", "ия", "ина", "елла")),
    (r"\p{IsGreek}", "βγδζθκλμνπρστφ", "αειου", "ν", ("ος", "ης", "ας", "ιος"), ("α", "ια", "ινα", "ελλα")),
    ("", "bcdfghjklmnprstvz", "aeiou", "n", ("o", "us", "er", "in"), ("a", "ia", "ine", "ella")),
)
ROUNDS = 64


def _type(mention: Column) -> Column:
    out = None
    for name, pattern in PATTERNS.items():
        if name in ("man", "woman"):
            continue
        test = mention.rlike(f"^(?:{pattern})$")
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


def _canonical(kind: Column, mention: Column) -> Column:
    plain = F.regexp_replace(mention, r"[^0-9A-Za-z]", "")
    return (
        F.when(kind.isin("email", "man", "woman"), F.lower(mention))
        .when(kind.isin("ip", "secret"), mention)
        .otherwise(plain)
    )


def _pick(seed: Column, place: Column, n: Column | int) -> Column:
    """A number below ``n`` from the keyed seed and a place."""
    return F.pmod(F.xxhash64(seed, place), F.lit(n) if isinstance(n, int) else n).cast("int")


def _letters(chars: str, i: Column) -> Column:
    return F.substring(F.lit(chars), i + 1, F.lit(1))


def _same_class(c: Column, i: Column, seed: Column) -> Column:
    """A character of the same class: digit, Latin, Greek or Cyrillic letter in the same case. Letters and digits of other
    scripts become Latin letters and 0 to 9, so that none stays; signs stay."""
    out = F.when(c.rlike(r"\p{Nd}"), _letters("0123456789", _pick(seed, i, 10)))
    for pattern, chars in (
        (r"[\p{Ll}&&\p{IsGreek}]", "αβγδεζηθικλμνξοπρστυφχψω"),
        (r"[\p{Lu}&&\p{IsGreek}]", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
        (r"[\p{Ll}&&\p{IsCyrillic}]", "абвгдежзиклмнопрстуфхцчшыэюя"),
        (r"[\p{Lu}&&\p{IsCyrillic}]", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЫЭЮЯ"),
        (r"\p{Lu}", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        (r"[\p{L}\p{M}\p{N}]", "abcdefghijklmnopqrstuvwxyz"),
    ):
        out = out.when(c.rlike(pattern), _letters(chars, _pick(seed, i, len(chars))))
    return out.otherwise(c)


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _remade(text: Column, seed: Column, fixed: Column | int = 0) -> Column:
    """Every character but the first ``fixed`` ones replaced within its class; a leading digit is never 0."""
    fixed = F.lit(fixed) if isinstance(fixed, int) else fixed

    def one(c: Column, i: Column) -> Column:
        lead = (i == fixed) & c.rlike("[1-9]")
        return F.when(i < fixed, c).when(lead, _letters("123456789", _pick(seed, i, 9))).otherwise(_same_class(c, i, seed))

    return F.array_join(F.transform(_chars(text), one), "")


def _check_digit(body: Column) -> Column:
    """Luhn digit that follows ``body``."""
    digits = F.reverse(_chars(body))

    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.transform(digits, worth), F.lit(0), lambda a, b: a + b)
    return ((F.lit(10) - total % 10) % 10).cast("string")


def _name_parts(name: Column) -> Column:
    """Words of a name and the signs between them, in turn."""
    return F.regexp_extract_all(name, F.lit(r"[\p{L}\p{M}0-9]+|[^\p{L}\p{M}0-9]+"), 0)


def _is_word(part: Column) -> Column:
    return part.rlike(r"^[\p{L}\p{M}0-9]") & ~part.isin(*WITHIN)


def _syllables(seed: Column, text: Column, woman: bool) -> Column:
    """A name of as many words in the script of ``text``: syllables, and an ending of the first word that fits the gender.
    Initials become initials; signs and small words between stay."""
    out = None
    for script, consonants, vowels, link, men, women in SCRIPTS:
        ends = women if woman else men

        def word(w: Column, i: Column) -> Column:
            pairs = F.sequence(F.lit(1), F.greatest(F.lit(2), F.ceil(F.length(w) / 2)).cast("int"))
            body = F.transform(
                pairs,
                lambda k: F.concat(
                    _letters(consonants, _pick(seed, i * 100 + k * 2, len(consonants))),
                    _letters(vowels, _pick(seed, i * 100 + k * 2 + 1, len(vowels))),
                ),
            )
            end = F.element_at(F.array(*[F.lit(e) for e in ends]), _pick(seed, i * 100, len(ends)) + 1)
            whole = F.concat(F.array_join(body, ""), F.when(i == 0, F.concat(F.lit(link), end)).otherwise(F.lit("")))
            initial = _letters(consonants, _pick(seed, i * 100, len(consonants)))
            return F.when(~_is_word(w), w).when(F.length(w) == 1, initial).otherwise(whole)

        made = F.array_join(F.transform(_name_parts(text), word), "")
        here = text.rlike(script)
        out = F.when(here, made) if out is None else out.when(here, made)
    return out


def _octet(o: Column, i: Column, seed: Column) -> Column:
    n = F.length(o)
    return (
        F.when(n == 1, _pick(seed, i, 9) + 1).when(n == 2, _pick(seed, i, 90) + 10).otherwise(_pick(seed, i, 156) + 100)
    ).cast("string")


def _surrogate(kind: Column, canon: Column, seed: Column) -> Column:
    """Surrogate of a canonical form. After the first rounds crowded short forms get longer."""
    local, host = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    top = F.substring_index(host, ".", -1)
    host_body = F.substring(host, F.lit(1), F.length(host) - F.length(top) - 1)
    mail = F.concat(_remade(local, seed), F.lit("@"), _remade(host_body, F.concat(seed, F.lit("h"))), F.lit("."), top)
    body = F.substring(canon, F.lit(1), F.length(canon) - 1)
    made = _remade(body, seed)
    card = F.concat(
        made,
        F.when(_check_digit(body) == F.substring(canon, -1, 1), _check_digit(made)).otherwise(
            _letters("0123456789", _pick(seed, F.lit(99), 10))
        ),
    )
    country = F.when(F.length(canon) > 10, F.length(canon) - 10).otherwise(F.lit(0))
    host_number = F.array_join(F.transform(F.split(canon, r"\."), lambda o, i: _octet(o, i, seed)), ".")
    return (
        F.when(kind == "email", mail)
        .when(kind == "ip", host_number)
        .when(kind == "card", card)
        .when(kind == "phone", _remade(canon, seed, country))
        .when(kind == "secret", _remade(canon, seed, 4))
        .when(kind == "iban", _remade(canon, seed, 2))
        .when(kind == "man", _syllables(seed, canon, False))
        .when(kind == "woman", _syllables(seed, canon, True))
        .otherwise(_remade(canon, seed))
    )


def _written(kind: Column, mention: Column, made: Column) -> Column:
    """The surrogate in the form of a mention: its separators, and its capitals."""
    is_name = kind.isin("man", "woman")
    name = F.array_join(F.transform(_name_parts(made), lambda w: F.when(_is_word(w), F.initcap(w)).otherwise(w)), "")
    chars, new = _chars(mention), _chars(made)
    aligned = kind.isin("email", "ip", "secret")

    def one(c: Column, i: Column) -> Column:
        sign = ~c.rlike("[0-9A-Za-z]")
        used = F.size(F.filter(F.slice(chars, F.lit(1), i), lambda x: x.rlike("[0-9A-Za-z]")))
        at = F.when(aligned, i).otherwise(used)
        got = F.coalesce(F.get(new, at), c)
        cased = F.when(c.rlike(r"\p{Lu}"), F.upper(got)).otherwise(got)
        return F.when(~aligned & sign, c).otherwise(cased)

    plain = F.array_join(F.transform(chars, one), "")
    filled = F.when(aligned, F.size(chars)).otherwise(F.size(F.filter(chars, lambda x: x.rlike("[0-9A-Za-z]"))))
    longer = F.array_join(F.slice(new, filled + 1, F.greatest(F.lit(0), F.size(new) - filled)), "")
    return F.when(is_name, name).otherwise(F.concat(plain, longer))


def mentions(docs: DataFrame) -> DataFrame:
    """(row, place, kind, mention) of every entity; ``row`` names a text, ``place`` counts its mentions."""
    found = docs.where(F.col("text").rlike(ANY)).select(F.xxhash64("text").alias("row"), "text").dropDuplicates(["row"])
    parts, said = F.split("text", ANY, -1), F.regexp_extract_all("text", F.lit(ANY), 0)
    laid = found.select("row", parts.alias("parts"), F.posexplode(said).alias("place", "mention"))
    # Names have no form of their own; the title before them tells the gender.
    before = F.get("parts", F.col("place"))
    woman = before.rlike(r"(?:Mrs|Ms|Frau|Madame|Señora)\b\.? $")
    kind = F.coalesce(_type(F.col("mention")), F.when(woman, "woman").otherwise("man"))
    return laid.select("row", "place", kind.alias("kind"), "mention")


def surrogates(found: DataFrame, key: str, rounds: int = ROUNDS) -> DataFrame:
    """(kind, canon, made): a surrogate for every entity of ``found`` (kind, canon), all distinct and none a real entity.

    Runs until no two collide. A form with fewer free values than entities would never end, so after ``rounds`` rounds
    what still collides gets its own number in the order of entities as an ending.
    """
    real = stored(found.distinct(), "entities")
    taken = real.select("kind", F.col("canon").alias("made")).withColumn("real", F.lit(True))
    open_ = real
    done = None
    for attempt in range(rounds + 1):
        seed = F.sha2(F.concat_ws("|", F.lit(key), "kind", "canon", F.lit(str(attempt))), 256)
        tried = open_.withColumn("made", _surrogate(F.col("kind"), F.col("canon"), seed))
        if attempt == rounds:
            tried = tried.withColumn("made", F.concat("made", F.substring(seed, 1, 16)))
        first = tried.groupBy("kind", "made").agg(F.min("canon").alias("first"))
        used = taken if done is None else taken.select("kind", "made").union(done.select("kind", "made"))
        free = first.join(used.select("kind", "made"), ["kind", "made"], "left_anti")
        won = tried.join(free.withColumnRenamed("first", "canon"), ["kind", "made", "canon"], "left_semi")
        won = stored(won.select("kind", "canon", "made"), "surrogates")
        done = won if done is None else done.union(won)
        open_ = stored(open_.join(won.select("kind", "canon"), ["kind", "canon"], "left_anti"), "open")
        if open_.isEmpty():
            break
    return done


def replace_pii(docs: DataFrame, key: str = "surrogates") -> DataFrame:
    """The rows of ``docs`` with surrogates in ``text``, and a struct column ``pii`` (n_entities, kinds).

    Null and empty texts stay as they are, with no entities; so does a text without any. Equal mentions and mentions
    that differ in separators or capitals get the same surrogate everywhere, under one ``key``. Repeated rows get equal
    texts. Names are found after a title only, and the whole mention is the entity: later mentions without the title stay, and
    "Mr John Smith" and "Mr Smith" are two entities. Other columns come through, whatever their names; an older ``pii`` is replaced. Texts are never cut.
    """
    found = mentions(docs).withColumn("canon", _canonical(F.col("kind"), F.col("mention")))
    found = stored(found, "mentions")
    made = surrogates(found.select("kind", "canon"), key)
    named = found.join(made, ["kind", "canon"]).select(
        "row", "place", "kind", _written(F.col("kind"), F.col("mention"), F.col("made")).alias("new")
    )
    per_text = named.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "new", "kind"))).alias("new"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    joined = rows.join(per_text, F.xxhash64("_row.text") == F.col("row"), "left")
    parts = F.split("_row.text", ANY, -1)
    pieces = F.transform(F.col("new"), lambda x, i: F.concat(F.get(parts, i), x["new"]))
    text = F.when(F.col("new").isNull(), F.col("_row.text")).otherwise(
        F.concat(F.array_join(pieces, ""), F.element_at(parts, -1))
    )
    kinds = F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.col("new.kind"))), ","), F.lit(""))
    info = F.struct(
        F.greatest(F.lit(0), F.coalesce(F.size("new"), F.lit(0))).cast("long").alias("n_entities"), kinds.alias("kinds")
    )
    same = [c for c in docs.columns if c != "pii"]
    return joined.select(
        *[text.alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in same], info.alias("pii")
    )
