"""Personal data: detection and surrogate generation with DataFrame functions only.

One pattern finds e-mail addresses, payment cards, telephone numbers, IPv4
addresses, social security numbers, IBANs, access keys, hexadecimal secrets and
names after a form of address, in whole texts; other mentions of a name's words
in the same text, without a title, follow.  Digits count as a card only if their
Luhn digit is right.  Every entity (kind, canonical form) gets a surrogate from a
keyed SHA-512 stream: the same entity has the same surrogate in all documents and
formats.  Surrogates keep the kind: digits fill the places and separators of the
number as written, country codes and issuer digits stay, Luhn and IBAN check
digits are right, addresses go to reserved domains and networks, letters keep case
and script (Latin, Cyrillic, Greek), names keep word count and gender.

A name's words are its entities, whatever the title.  A given name has the gender
of its titles in the whole corpus: that of all that tell one, or a neutral
surrogate if they tell none or both.

Collision checks over the distinct entities of the corpus: surrogates that two
entities share, or that are themselves an entity, are drawn again (the least
canonical form keeps its draw) until all differ.  Entities that still collide after
``MOST_DRAWS`` draws, because their format has too few surrogates, become
``[KIND-hexadecimal]`` of 128 keyed bits: distinct and alike everywhere, without
their format.  Entities drawn again, or whose title does not tell their gender, are
few; their texts get a list of them by a join on the text's content key, broadcast
only while that list has at most ``BROADCAST_TEXTS`` texts and entities.

Defined cases: null text stays null and has no entities; empty text stays empty;
repeated rows change alike; a text that is nothing but an entity is replaced
whole; a bare word that is both a given and a family name of its text counts as the
family name; an empty table gives no rows; other columns pass, and one called like
a result column is kept inside ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, let, read, text_key

KEY = "surrogate-key"
BROADCAST_TEXTS = 50_000
MOST_DRAWS = 16

# What is detected, in order of precedence.
MEN = r"Mr\.?|Herr|Monsieur|Señor|Sir|г-н|господин|κύριος"
WOMEN = r"Mrs\.?|Ms\.?|Miss|Frau|Madame|Señora|Señorita|г-жа|госпожа|κυρία"
ANYONE = r"Dr\.?|Prof\.?"
NAME = r"\p{Lu}(?:\p{L}|-\p{L}|['’](?=\p{Lu}\p{L}))+"
KINDS = {
    "email": r"[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)*\.\p{L}{2,}",
    "ip": r"(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)",
    "ssn": r"\d{3}-\d{2}-\d{4}(?![\d\-])",
    "phone": r"\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,3}(?!\d)"
             r"|\(\d{3}\)[ .\-]?\d{3}[ .\-]\d{4}(?!\d)|\d{3}[.\-]\d{3}[.\-]\d{4}(?![\d\-])",
    "card": r"\d{13,19}(?!\d)|\d{4}(?:[ \-]\d{4}){2}[ \-]\d{1,7}(?!\d)|\d{4}[ \-]\d{6}[ \-]\d{4,5}(?!\d)",
    "access_key": r"A[KS]IA[A-Z0-9]{16}(?![A-Z0-9])",
    "secret": r"[0-9a-f]{32,128}(?![\p{L}\p{N}])|[0-9A-F]{32,128}(?![\p{L}\p{N}])",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])",
    "name": rf"(?:{MEN}|{WOMEN}|{ANYONE}) {NAME}(?: {NAME})?",
}
BARE = rf"(?<![\p{{L}}\p{{N}}_@]){NAME}(?![\p{{N}}_@])"
DETECT = r"(?<![\p{L}\p{N}_%+@])(?:" + "|".join(f"(?:{p})" for p in KINDS.values()) + ")"

ENTITIES = "array<struct<kind:string,form:string,written:string,gender:string>>"

# Letters that hexadecimal digits turn into, by script.
HEX = "0123456789abcdef"
DIGITS = "0123456789314159"
LATIN = "bdfghjkmnprstvwz"
CYRILLIC = "бвгджзклмнпрстфх"
GREEK = "βγδζθκλμνξπρστφχ"
VOWELS = {LATIN: "aeiouaeiouaeioua", CYRILLIC: "аеиоуаеиоуаеиоуа", GREEK: "αειουαειουαειουα"}
CAPITALS = "ACDEFGHJKLMNPQRS"


def matches(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(DETECT), F.lit(0))


def kind_of(match: Column) -> Column:
    """The kind of a match of ``DETECT``; null for digits in the form of a card that are none."""
    out = F.lit("name")
    for kind, pattern in reversed([x for x in KINDS.items() if x[0] != "name"]):
        known = F.when(_luhn(F.substr(_only_digits(match), F.lit(1), F.length(_only_digits(match)) - 1)) == F.right(match, F.lit(1)),
                       F.lit(kind)) if kind == "card" else F.lit(kind)
        out = F.when(match.rlike(f"^(?:{pattern})$"), known).otherwise(out)
    return out


def _only_digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def canonical(kind: Column, written: Column) -> Column:
    """One form for all ways of writing an entity; a telephone number keeps its country code apart."""
    country = F.regexp_extract(written, r"^\+(\d{1,3})(?=\D)", 1)
    return (F.when(kind == "email", F.lower(written))
            .when(kind.isin("ssn", "card"), _only_digits(written))
            .when(kind == "phone", F.concat(country, F.lit("|"), F.substr(_only_digits(written), F.length(country) + 1)))
            .when(kind == "iban", F.replace(written, F.lit(" "), F.lit("")))
            .when(kind.isin("given", "family", "secret"), F.lower(written))
            .otherwise(written))


def entities(match: Column) -> Column:
    """(kind, form, written, gender) of a match; a name has one entity per word."""
    def entity(kind, written, gender):
        return F.struct(kind.alias("kind"), canonical(kind, written).alias("form"), written.alias("written"), gender.alias("gender"))

    title = F.regexp_extract(match, rf"^({MEN}|{WOMEN}|{ANYONE}) ", 1)
    words = F.split(F.substr(match, F.length(title) + 2), " ")
    gender = F.when(title.rlike(f"^(?:{MEN})$"), F.lit("m")).when(title.rlike(f"^(?:{WOMEN})$"), F.lit("f")).otherwise(F.lit(""))
    named = F.transform(words, lambda w, i: F.when(i < F.size(words) - 1, entity(F.lit("given"), w, gender)).otherwise(
        entity(F.lit("family"), w, F.lit(""))))
    return let(kind_of(match), lambda kind: F.when(kind.isNull(), F.array().cast(ENTITIES)).when(
        kind == "name", named.cast(ENTITIES)).otherwise(F.array(entity(kind, match, F.lit(""))).cast(ENTITIES)))


def _at(stream: Column, i: Column) -> Column:
    return F.substr(stream, i % 128 + 1, F.lit(1))


def _shaped(text: Column, seed: Column) -> Column:
    """``text`` with every letter and digit drawn anew, of the same case and script."""
    streams = {k: F.translate(seed, HEX, v) for k, v in (("d", DIGITS), ("l", LATIN), ("c", CYRILLIC), ("g", GREEK))}

    def one(c: Column, i: Column) -> Column:
        low = (F.when(c.rlike(r"\p{N}"), _at(streams["d"], i)).when(c.rlike(r"\p{IsCyrillic}"), _at(streams["c"], i))
               .when(c.rlike(r"\p{IsGreek}"), _at(streams["g"], i)).when(c.rlike(r"\p{L}"), _at(streams["l"], i)).otherwise(c))
        return F.when(c.rlike(r"\p{Lu}"), F.upper(low)).otherwise(low)
    return F.array_join(F.transform(F.split(text, ""), one), "")


def _word(seed: Column, letters: str, syllables: int) -> Column:
    consonants, vowels = F.translate(seed, HEX, letters), F.translate(seed, HEX, VOWELS[letters])
    return F.concat(*[x for i in range(syllables) for x in (F.substring(consonants, 2 * i + 1, 1), F.substring(vowels, 2 * i + 2, 1))])


def _octet(seed: Column, at: int) -> Column:
    return F.conv(F.substring(seed, at, 2), 16, 10)


def _luhn(body: Column) -> Column:
    """Check digit of a string of digits."""
    total = F.aggregate(F.reverse(F.split(body, "")), F.struct(F.lit(0).alias("n"), F.lit(True).alias("twice")), lambda a, c: let(
        c.cast("int") * F.when(a["twice"], 2).otherwise(1),
        lambda d: F.struct((a["n"] + F.when(d > 9, d - 9).otherwise(d)).alias("n"), (~a["twice"]).alias("twice"))), lambda a: a["n"])
    return ((10 - total % 10) % 10).cast("string")


def _iban_check(country: Column, rest: Column) -> Column:
    """Check digits of an IBAN: its letters count 10 to 35, the whole is 1 modulo 97."""
    left = F.aggregate(F.split(F.concat(rest, country, F.lit("00")), ""), F.lit(0), lambda a, c: F.when(
        c.rlike(r"\d"), a * 10 + F.ascii(c) - 48).otherwise(a * 100 + F.ascii(c) - 55) % 97)
    return F.lpad((98 - left % 97).cast("string"), 2, "0")


def surrogate(kind: Column, form: Column, draw: Column, gender: Column, key: str = KEY) -> Column:
    """Canonical surrogate of an entity at its ``draw``-th drawing; a negative one gives up the format."""
    text = F.concat_ws("|", F.lit(key), kind, form, draw.cast("string"))
    script = lambda make: F.when(form.rlike(r"\p{IsCyrillic}"), make(CYRILLIC)).when(
        form.rlike(r"\p{IsGreek}"), make(GREEK)).otherwise(make(LATIN))

    def make(seed: Column) -> Column:
        digits = F.translate(seed, HEX, DIGITS)
        country, number = F.substring_index(form, "|", 1), F.substring_index(form, "|", -1)
        ending = lambda l: F.when(gender == "f", F.lit(VOWELS[l][0])).when(
            gender == "m", F.substring(F.translate(seed, HEX, l), 40, 1)).otherwise(F.lit(""))
        body = F.concat(F.substring(form, 1, 1), F.substr(digits, F.lit(2), F.length(form) - 2))
        return (F.when(draw < 0, F.concat(F.lit("["), F.upper(kind), F.lit("-"), F.substring(seed, 1, 32), F.lit("]")))
                .when(kind == "email", F.concat(_shaped(F.substring_index(form, "@", 1), seed), F.lit("@mail"),
                                                 F.substring(digits, 100, 2), F.lit(".example.net")))
                .when(kind == "ip", F.concat_ws(".", F.when(draw < 3, F.lit("10")).otherwise(_octet(seed, 7)),
                                                _octet(seed, 1), _octet(seed, 3), _octet(seed, 5)))
                .when(kind == "ssn", F.concat(F.lit("9"), F.substring(digits, 1, 8)))
                .when(kind == "phone", F.concat(country, F.substr(digits, F.lit(1), F.length(number))))
                .when(kind == "card", F.concat(body, _luhn(body)))
                .when(kind == "access_key", F.concat(F.substring(form, 1, 4), F.substring(F.translate(seed, HEX, CAPITALS), 1, 16)))
                .when(kind == "secret", F.substr(seed, F.lit(1), F.length(form)))
                .when(kind == "iban", let(_shaped(F.substr(form, F.lit(5)), seed), lambda rest: F.concat(
                    F.substring(form, 1, 2), _iban_check(F.substring(form, 1, 2), rest), rest)))
                .when(kind == "family", F.initcap(script(lambda l: _word(seed, l, 4))))
                .otherwise(F.initcap(F.concat(script(lambda l: _word(seed, l, 3)), script(ending)))))
    return let(F.sha2(text, 512), make)


def render(kind: Column, written: Column, core: Column, draw: Column) -> Column:
    """The surrogate in the format of the original."""
    def filled(place: str) -> Column:  # the n-th place takes the n-th character
        nth = lambda i: F.regexp_count(F.substr(written, F.lit(1), i + 1), F.lit(place))
        return F.array_join(F.transform(F.split(written, ""), lambda c, i: F.when(
            c.rlike(place), F.substr(core, nth(i), F.lit(1))).otherwise(c)), "")

    capitals = (written == F.upper(written)) & (F.length(written) > 1)
    return (F.when(draw < 0, core).when(kind.isin("ssn", "phone", "card"), filled(r"\d")).when(kind == "iban", filled("[A-Z0-9]"))
            .when(kind.isin("ip", "access_key"), core)
            .when(capitals & written.rlike(r"\p{L}"), F.upper(core)).otherwise(core))


def assign(found: DataFrame, key: str = KEY, most_draws: int = MOST_DRAWS) -> DataFrame:
    """(kind, form, gender, draw) of the distinct entities in ``found``, rows of (kind, form, gender); all surrogates differ."""
    told = F.when(F.col("gender") != "", F.col("gender"))
    people = found.groupBy("kind", "form").agg(
        F.coalesce(F.when(F.min(told) == F.max(told), F.min(told)), F.lit("")).alias("gender"))
    drawn = lambda df: df.withColumn("core", surrogate(*map(F.col, ("kind", "form", "draw", "gender")), key))
    now = cut(drawn(people.withColumn("draw", F.lit(0))))
    own = now.select("kind", F.replace("form", F.lit("|"), F.lit("")).alias("core")).distinct()
    low = F.lower("core").alias("core")
    for turn in range(1, most_draws + 1):
        # Of those that share a surrogate the earliest draw, then the least form, keeps it.
        first = now.groupBy("kind", low).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("draw", "form")).alias("keeper")).filter("n > 1")
        shared = now.alias("e").join(first.alias("f"), (F.col("e.kind") == F.col("f.kind")) & (F.lower("e.core") == F.col("f.core"))).filter(
            F.col("e.form") != F.col("f.keeper.form")).select("e.kind", "e.form")
        real = now.select("kind", "form", low).join(own.select("kind", low), ["kind", "core"], "left_semi").select("kind", "form")
        again = cut(shared.unionByName(real).distinct().withColumn("again", F.lit(1)))
        if again.isEmpty():
            break
        moved = now.join(again, ["kind", "form"], "left")
        next_draw = F.when(F.col("again").isNull(), F.col("draw")).otherwise(F.lit(-1) if turn == most_draws else F.col("draw") + 1)
        now = cut(drawn(moved.select("kind", "form", "gender", next_draw.alias("draw"))))
    return now.select("kind", "form", "gender", "draw")


def replace_entities(docs: DataFrame, key: str = KEY, most_draws: int = MOST_DRAWS) -> DataFrame:
    """(row, text, n_entities, kinds, n_bare): ``row`` has the columns of ``docs``; ``text`` carries the surrogates.

    ``n_entities`` and ``kinds`` count the matches of the pattern, ``n_bare`` the
    words of their names that stand elsewhere in the text.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("old"), text_key(F.col("text")).alias("key"))
    found = rows.select("key", F.explode(F.flatten(F.transform(matches(F.col("old")), entities))).alias("e")).select(
        "key", "e.kind", "e.form", "e.gender")
    found = cut(found.distinct())
    known = assign(found.select("kind", "form", "gender").distinct(), key, most_draws).withColumnRenamed("gender", "real")
    late = found.join(known, ["kind", "form"]).filter((F.col("draw") != 0) | (F.col("gender") != F.col("real")))
    late_in = cut(late.select("key", "kind", "form", "draw", "real").distinct().groupBy("key").agg(F.map_from_entries(F.collect_list(
        F.struct(F.concat("kind", F.lit("|"), "form"), F.struct("draw", F.col("real").alias("gender"))))).alias("late")))
    sizes = late_in.agg(F.count(F.lit(1)).alias("texts"), F.sum(F.size("late")).alias("entities")).first()  # one row
    few = max(sizes["texts"], sizes["entities"] or 0) <= BROADCAST_TEXTS
    rows = rows.join(F.broadcast(late_in) if few else late_in.hint("shuffle_hash"), "key", "left")

    def drawn(e: Column, written: Column) -> Column:
        return let(F.element_at("late", F.concat(e["kind"], F.lit("|"), e["form"])), lambda at: let(
            F.struct(F.coalesce(at["draw"], F.lit(0)).alias("draw"), F.coalesce(at["gender"], e["gender"]).alias("gender")),
            lambda d: let(surrogate(e["kind"], e["form"], d["draw"], d["gender"], key),
                          lambda core: render(e["kind"], written, core, d["draw"]))))

    def replaced(match: Column) -> Column:
        title = F.regexp_extract(match, rf"^(?:(?:{MEN}|{WOMEN}|{ANYONE}) (?={NAME}))?", 0)
        return let(entities(match), lambda es: F.when(F.size(es) == 0, match).otherwise(
            F.concat(title, F.array_join(F.transform(es, lambda e: drawn(e, e["written"])), " "))))

    def bare(piece: Column, names: Column, forms: Column) -> Column:
        """(text, n): a stretch between matches with the words of the text's names replaced."""
        words, gaps = F.regexp_extract_all(piece, F.lit(BARE), F.lit(0)), F.split(piece, BARE)
        new = F.transform(words, lambda w: let(F.array_position(forms, F.lower(w)), lambda at: F.struct(F.when(at > 0, let(
            F.get(names, (at - 1).cast("int")), lambda e: drawn(e, w))).otherwise(w).alias("w"), (at > 0).cast("long").alias("n"))))
        return let(new, lambda new: F.struct(F.array_join(F.zip_with(gaps, new, lambda gap, w: F.concat(
            gap, F.coalesce(w["w"], F.lit("")))), "").alias("text"), F.aggregate(new, F.lit(0).cast("long"), lambda a, w: a + w["n"]).alias("n")))

    rows = rows.withColumn("found", matches(F.col("old")))
    names = F.array_distinct(F.filter(F.flatten(F.transform(F.filter("found", lambda m: m.rlike(f"^(?:{KINDS['name']})$")), entities)),
                                      lambda e: e["kind"].isin("given", "family")))
    families_first = F.concat(F.filter(names, lambda e: e["kind"] == "family"), F.filter(names, lambda e: e["kind"] == "given"))
    kept = F.transform(F.split("old", DETECT), lambda piece: F.struct(piece.alias("text"), F.lit(0).cast("long").alias("n")))
    between = let(families_first, lambda names: F.when(F.size(names) == 0, kept).otherwise(let(
        F.transform(names, lambda e: e["form"]), lambda forms: F.transform(F.split("old", DETECT), lambda piece: bare(piece, names, forms)))))
    new = let(between, lambda pieces: F.struct(
        F.array_join(F.zip_with(pieces, F.transform("found", replaced), lambda piece, r: F.concat(piece["text"], F.coalesce(r, F.lit("")))), "").alias("text"),
        F.aggregate(pieces, F.lit(0).cast("long"), lambda a, piece: a + piece["n"]).alias("n")))
    rows = rows.select("row", F.when(F.size("found") == 0, F.struct(F.col("old").alias("text"), F.lit(0).cast("long").alias("n"))).otherwise(new).alias("new"),
                       F.filter(F.transform("found", kind_of), lambda kind: kind.isNotNull()).alias("kinds"))
    return rows.select("row", "new.text", F.size("kinds").cast("long").alias("n_entities"), "kinds", F.col("new.n").alias("n_bare"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "row.doc_id", "text", "n_entities", F.array_join("kinds", ",").alias("kinds"), "n_bare")
