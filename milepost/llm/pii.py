"""Operator 7 (native): personal data replaced by generated surrogates.

Detected are e-mail addresses, phone numbers, IPv4 addresses, card numbers (only
with a valid check digit) and titled person names.  An entity is (kind,
canonical form); all its mentions, in all documents, get the same surrogate
(coreference), which is drawn by a keyed hash and matches the type: letters stay
letters of their script and case, digits stay digits, separators, country code,
top-level domain, octet range, check digit and a title's gender are kept.

Distinctness: surrogates are assigned in rounds over the distinct entities.  A
candidate that another entity also drew (the smallest canonical form keeps it),
that is taken, or that is itself an entity of the corpus is drawn again with the
next attempt, until none is left; names get a syllable more every four attempts and
numbers digits after ``STRICT_ATTEMPTS``, so the rounds end however many there are.
A phone number is known by its last ten digits; a country code before them stays.

Everything is SQL expressions, joins and aggregates.  Only documents with
entities take part in a shuffle; the entity table is pre-aggregated, so an
entity that a third of the rows mention is one row there.

Defined results: null text stays null; a row without entities is unchanged;
every row gives one row; rows with equal id and text get equal texts; a null id
stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.llm.common import checkpointed, id_text, read_table

KINDS = ("email", "phone", "ip", "card", "name")
# Titles by gender, given names by script and gender, name syllables.
MALE_TITLES = ("Mr", "Herr", "Señor", "Monsieur", "Sir", "Господин")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme", "Госпожа")
GIVEN = {("latin", "m"): ("Adam", "Paul", "Oskar", "Victor", "Emil", "Martin", "Hugo", "Simon"),
         ("latin", "f"): ("Anna", "Clara", "Julia", "Marta", "Elena", "Sofia", "Nina", "Laura"),
         ("cyrillic", "m"): ("Павел", "Антон", "Олег", "Виктор"),
         ("cyrillic", "f"): ("Анна", "Елена", "Мария", "Вера")}
SYLLABLES = {"latin": ("bar", "den", "fal", "gor", "hal", "kel", "lin", "mor", "nor", "pel", "ras", "sol", "tam", "ver", "wil", "zan"),
             "cyrillic": ("бар", "вел", "гор", "дан", "кор", "лин", "мир", "нов", "пел", "рас", "сол", "там")}
_NAME = r"\p{Lu}\p{Ll}+"
_TITLE = "(?:" + "|".join(sorted(MALE_TITLES + FEMALE_TITLES, key=len, reverse=True)) + r")\.? "
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERN = "|".join((
    r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3}[ .-]?\d{4}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}"
    r"|(?<![.(-])\d{3}-\d{3}-\d{4}(?!-\d))(?!\d)",
    rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\d|\.\d)",
    r"(?<![\p{L}\p{N}])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\p{L}\p{N}])",
    rf"(?<![\p{{L}}\p{{N}}]){_TITLE}{_NAME}(?: {_NAME})?"))
#: Attempts that keep the exact lengths.  Later ones get longer with the attempt, so that
#: no number of entities exhausts what can be drawn.
STRICT_ATTEMPTS = 16


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, r"\D", "")


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of a digit string (0: valid)."""
    doubled = F.transform(F.reverse(_chars(digits)), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10


def kind_of(m: Column) -> Column:
    """Kind of a match of PATTERN; null for a number that fails the check digit."""
    return F.when(F.contains(m, F.lit("@")), "email") \
        .when(F.regexp_like(m, F.lit(r"^\p{L}")), "name") \
        .when(F.regexp_like(m, F.lit(r"^(?:[+(]|\d{3}-\d{3}-\d{4}$)")), "phone") \
        .when(F.contains(m, F.lit(".")), "ip") \
        .when(_luhn(_digits(m)) == 0, "card")


def canonical(kind: Column, m: Column) -> Column:
    """What all mentions of one entity share."""
    title = F.regexp_extract(m, rf"^({_TITLE})", 1)
    gender = F.when(F.regexp_replace(title, r"[. ]", "").isin(*FEMALE_TITLES), "f").otherwise("m")
    return F.when(kind == "phone", F.right(_digits(m), F.lit(10))).when(kind == "card", _digits(m)) \
        .when(kind == "name", F.concat(gender, F.lit(":"), F.lower(F.regexp_replace(m, rf"^{_TITLE}", "")))) \
        .otherwise(F.lower(m))


def _entities(text: Column) -> Column:
    """Distinct (kind, canon) of a text."""
    found = F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))), lambda m: _let(
        kind_of(m), lambda k: F.struct(k.alias("kind"), canonical(k, m).alias("canon"))))
    return F.array_distinct(F.filter(found, lambda e: e["kind"].isNotNull()))


def _draw(key: str, n, i) -> Column:
    """A keyed number for the i-th choice of a row's (kind, canon, attempt)."""
    word = F.concat_ws("|", F.lit(key), F.col("kind"), F.col("canon"), F.col("attempt").cast("string"),
                       i.cast("string") if isinstance(i, Column) else F.lit(str(i)))
    drawn = F.conv(F.substring(F.sha2(word.cast("binary"), 256), 1, 12), 16, 10).cast("long")
    return F.pmod(drawn, n if isinstance(n, Column) else F.lit(n))


def _pick(letters: str, key: str, i: Column) -> Column:
    return F.substr(F.lit(letters), (_draw(key, len(letters), i) + 1).cast("int"), F.lit(1))


def _like(c: Column, key: str, i: Column) -> Column:
    """A character of the same script and kind as c."""
    return F.when(F.regexp_like(c, F.lit("[0-9]")), _pick("0123456789", key, i)) \
        .when(F.regexp_like(c, F.lit("[a-z]")), _pick("abcdefghijklmnopqrstuvwxyz", key, i)) \
        .when(F.regexp_like(c, F.lit(r"\p{IsCyrillic}")), _pick("абвгдежзиклмнопрстуфхцчшэюя", key, i)) \
        .when(F.regexp_like(c, F.lit(r"\p{IsGreek}")), _pick("αβγδεζηθικλμνξοπρστυφχψω", key, i)) \
        .when(F.regexp_like(c, F.lit(r"\p{IsLatin}")), _pick("áàâäéèêëíìîïóòôöúùûüñç", key, i)).otherwise(c)


def surrogate(key: str) -> Column:
    """Candidate for a row of kind, canon, attempt."""
    canon, late = F.col("canon"), F.col("attempt") >= STRICT_ATTEMPTS
    filled = F.array_join(F.transform(_chars(canon), lambda c, i: _like(c, key, i)), "")
    # e-mail: all but the top-level domain; late attempts lengthen the local part
    tld = F.regexp_extract(canon, r"(\.[^.]+)$", 1)
    email = F.concat(F.when(late, _pick("abcdefghijklmnopqrstuvwxyz", key, F.lit(1001))).otherwise(""),
                     F.when(late, _draw(key, 10**9, 1002).cast("string")).otherwise(""),
                     F.left(filled, F.length(canon) - F.length(tld)), tld)
    # one more digit every four late attempts
    more = F.when(late, F.array_join(F.transform(F.sequence(F.lit(1), F.floor((F.col("attempt") - STRICT_ATTEMPTS) / 4) + 1),
                                                 lambda i: _pick("0123456789", key, i + 2000)), "")).otherwise("")
    phone = F.concat(filled, more)
    low = F.array(F.lit(0), F.lit(10), F.lit(100))
    width = F.array(F.lit(10), F.lit(90), F.lit(155))
    ip = F.array_join(F.transform(F.split(canon, r"\."), lambda o, i: F.when(
        late, _draw(key, 254, i) + 1).otherwise(F.get(low, F.length(o) - 1) + _draw(key, F.get(width, F.length(o) - 1), i))
        .cast("string")), ".")
    ip = F.when(F.col("attempt") >= 4 * STRICT_ATTEMPTS, F.concat(ip, F.lit(":"), more)).otherwise(ip)
    # card: the first digit stays, the last one is the check digit of the rest
    body = F.concat(F.left(canon, F.lit(1)), F.substr(filled, F.lit(2), F.length(canon) - 2), more)
    card = F.concat(body, ((10 - _luhn(F.concat(body, F.lit("0")))) % 10).cast("string"))
    return F.when(F.col("kind") == "email", email).when(F.col("kind") == "phone", phone) \
        .when(F.col("kind") == "ip", ip).when(F.col("kind") == "card", card).otherwise(_person(key))


def _person(key: str) -> Column:
    canon = F.col("canon")
    two = F.contains(canon, F.lit(" "))

    def of(script: str, gender: str) -> Column:
        given = F.array(*[F.lit(x) for x in GIVEN[script, gender]])
        part = F.array(*[F.lit(x) for x in SYLLABLES[script]])
        n = len(SYLLABLES[script])
        length = 3 + F.floor(F.col("attempt") / 4)  # places after the first; longer where names run short
        family = F.initcap(F.concat(
            F.array_join(F.transform(F.sequence(F.lit(0), length), lambda j: F.get(
                part, _draw(key, n, j + 10).cast("int"))), ""),
            F.lit("а" if (script, gender) == ("cyrillic", "f") else "")))
        first = F.get(given, _draw(key, len(GIVEN[script, gender]), 1).cast("int"))
        return F.when(two, F.concat(first, F.lit(" "), family)).otherwise(family)

    female = F.startswith(canon, F.lit("f:"))
    return F.when(F.regexp_like(canon, F.lit(r"\p{IsCyrillic}")), F.when(female, of("cyrillic", "f")).otherwise(
        of("cyrillic", "m"))).when(female, of("latin", "f")).otherwise(of("latin", "m"))


def assign(entities: DataFrame, key: str) -> DataFrame:
    """kind, canon, surrogate: distinct and never an entity of the corpus."""
    own = checkpointed(entities.select("kind", "canon").distinct())
    bare = own.select("kind", F.regexp_replace("canon", "^[fm]:", "").alias("s"))
    pending, done = own.withColumn("attempt", F.lit(0)), None
    while True:
        drawn = pending.withColumn("surrogate", surrogate(key)).withColumn("s", F.lower("surrogate"))
        first = drawn.groupBy("kind", "s").agg(F.min("canon").alias("canon"))
        free = first.join(bare, ["kind", "s"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", F.lower("surrogate").alias("s")), ["kind", "s"], "left_anti")
        tried = checkpointed(drawn.join(free.withColumn("ok", F.lit(True)), ["kind", "canon", "s"], "left"))
        fine = tried.where("ok").select("kind", "canon", "surrogate")
        done = fine if done is None else checkpointed(done.union(fine))
        pending = tried.where("ok is null").select("kind", "canon", (F.col("attempt") + 1).alias("attempt"))
        if pending.isEmpty():
            return done


def _render(m: Column, chosen: Column) -> Column:
    """The mention with its surrogate: separators and case as they were."""
    def shown(kind: Column) -> Column:
        return _let(F.element_at(chosen, F.concat(kind, F.lit(":"), canonical(kind, m))), lambda s: F.when(
            s.isNull(), m).when(kind == "name", F.concat(F.regexp_extract(m, rf"^({_TITLE})", 1), s))
            .when(kind == "phone", by_digit(F.concat(F.left(_digits(m), F.length(_digits(m)) - 10), s)))
            .when(kind == "card", by_digit(s)).when(F.length(s) == F.length(m), by_place(s)).otherwise(s))

    def by_digit(s: Column) -> Column:
        put = F.array_join(F.transform(_chars(m), lambda c, i: F.when(F.regexp_like(c, F.lit("[0-9]")), F.substr(
            s, F.length(_digits(F.substr(m, F.lit(1), i + 1))), F.lit(1))).otherwise(c)), "")
        return F.concat(put, F.substr(s, F.length(_digits(m)) + 1))

    def by_place(s: Column) -> Column:
        return F.array_join(F.transform(_chars(m), lambda c, i: F.when(c != F.lower(c), F.upper(
            F.substr(s, i + 1, F.lit(1)))).otherwise(F.substr(s, i + 1, F.lit(1)))), "")

    return _let(kind_of(m), shown)


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (with surrogates), and how many entities of each kind it held."""
    own = id_text(docs, id_col, text_col).withColumn("entities", F.coalesce(
        _entities(F.col("text")), F.expr("cast(array() as array<struct<kind:string,canon:string>>)")))
    keyed = own.withColumns({"no_id": F.col("doc_id").isNull(), "kid": F.coalesce("doc_id", F.lit(0)),
                             "kh": F.xxhash64("text")})
    names = ["no_id", "kid", "kh"]
    mentions = checkpointed(keyed.where(F.size("entities") > 0).select(*names, F.explode("entities").alias("e"))
                            .select(*names, "e.kind", "e.canon").distinct())
    given = assign(mentions, key)
    maps = mentions.join(given, ["kind", "canon"]).groupBy(*names).agg(F.map_from_entries(F.collect_list(
        F.struct(F.concat("kind", F.lit(":"), "canon"), "surrogate"))).alias("chosen"))

    def count(kind: str) -> Column:
        return F.size(F.filter("entities", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    text = F.col("text")
    matches = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    parts = F.zip_with(F.split(text, PATTERN), F.concat(
        F.transform(matches, lambda m: _render(m, F.col("chosen"))), F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    touched = keyed.where(F.size("entities") > 0).join(maps, names).select(
        "doc_id", F.array_join(parts, "").alias("text"), *map(count, KINDS))
    rest = own.where(F.size("entities") == 0).select(
        "doc_id", "text", *[F.lit(0).cast("long").alias(f"n_{k}") for k in KINDS])
    return touched.union(rest)


def query(spark, sf_dir: str) -> DataFrame:
    return replace_entities(read_table(spark, sf_dir, "documents"), key="registered-query")
