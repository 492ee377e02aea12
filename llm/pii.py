"""Personal data replaced by surrogates of the same type and format.

Detected entities are reduced to a canonical form (lower-case mail, digits of a number, a name without
case), so that spellings of one entity get one surrogate in the whole corpus. A surrogate is derived
from the secret key, the type, the canonical form and an attempt number. Two entities never share a
surrogate and none is itself an entity of the corpus: where that happens, all but the first entity go
on to the next attempt. Rendering puts the surrogate into the format of each occurrence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.shared import shared_path, stored

_FEMALE = r"Mrs|Ms|Miss|Frau|Señora|Señorita|Madame|Mme|Г-жа|Госпожа"
_MALE = r"Mr|Herr|Señor|Monsieur|Sir|Г-н|Господин"
_EITHER = r"Dr|Prof"
_NAME = r"\p{Lu}[\p{L}'’-]{1,40}(?: \p{Lu}[\p{L}'’-]{1,40}){0,2}"
_DIGIT = r"(?<![0-9A-Za-z])"
#: A group of digits in a run is no start of a word or mail address.
_GROUP_END = r"(?![A-Za-z]|[A-Za-z0-9._%+-]{0,64}@)"
PATTERNS = (
    ("email", r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.){1,8}[A-Za-z]{2,24}"),
    ("secret", r"(?<=(?i:password|passwd|token|secret|api_key)\s?[=:]\s?[\x22']?)[A-Za-z0-9+/_.-]{8,}"),
    ("key", r"(?<![0-9A-Za-z])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"),
    ("ip", r"(?<![0-9A-Za-z.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?!\.?[0-9A-Za-z])"),
    ("run", _DIGIT + rf"(?=[0-9](?:[ .-]?[0-9]){{12}})[0-9]++{_GROUP_END}(?:[ .-][0-9]++{_GROUP_END})*+"),
    ("ssn", _DIGIT + r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)|[0-9]{3})[ .-][0-9]{3}[ .-]?[0-9]{4}(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9A-Za-z])"),
    *(
        (kind, rf"(?<=\b(?:{titles})\.? ){_NAME}")
        for kind, titles in (("female", _FEMALE), ("male", _MALE), ("name", _EITHER))
    ),
)
ANY = "|".join(f"(?:{pattern})" for _, pattern in PATTERNS)
_CARD = r"^[0-9](?:[ -]?[0-9]){12,18}$"
_OWN_CARD = r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})$"
#: Every entity holds one of these, and most texts hold none.
HINT = rf"[0-9@]|(?i:password|passwd|token|secret|api_key)|\b(?:{_FEMALE}|{_MALE}|{_EITHER})\b"


def _let(value: Column, body) -> Column:
    """body applied to a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]+", "")


def luhn_valid(digits: Column) -> Column:
    def add(state: Column, digit: Column) -> Column:
        value = digit.cast("int") * F.when(state["odd"], 2).otherwise(1)
        return F.struct((state["sum"] + value - F.when(value > 9, 9).otherwise(0)).alias("sum"), (~state["odd"]).alias("odd"))

    start = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("odd"))
    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(chars, start, add)["sum"] % 10 == 0


def _typed(before: Column, entity: Column) -> Column:
    """The type of a match: the first pattern it fits; names and secrets by the text before them."""
    kind = F.when(before.rlike(rf"\b(?:{_FEMALE})\.? $"), "female").when(before.rlike(rf"\b(?:{_MALE})\.? $"), "male")
    kind = kind.when(before.rlike(rf"\b(?:{_EITHER})\.? $"), "name").otherwise("secret")
    for name, pattern in reversed(PATTERNS):
        if name not in ("female", "male", "name", "secret"):
            fits = entity.rlike(f"^(?:{pattern})$")
            kind = F.when(fits, F.lit(name)).otherwise(kind)
    return F.when(before.rlike(r"(?i:password|passwd|token|secret|api_key)\s?[=:]\s?[\x22']?$"), "secret").otherwise(kind)


def _part(lead: Column, entity: Column, kind: Column, tail: Column) -> Column:
    return F.struct(lead.alias("lead"), entity.alias("entity"), kind.alias("kind"), tail.alias("tail"))


def _parts(run: Column) -> Column:
    """A run of digit groups as its entities, each with the text before it, the last with the text after it.

    From left to right, each group not yet taken begins a card in a usual grouping, an address, a social
    security or phone number, or else the longest card in any grouping; cards need their check digit. A
    run that holds none is one part of kind other.
    """
    patterns = {name: f"^(?:{pattern})$" for name, pattern in reversed(PATTERNS)}

    def parsed(groups: Column) -> Column:
        def candidate(i: Column, k: Column) -> Column:
            def judged(text: Column) -> Column:
                valid = lambda pattern: text.rlike(pattern) & luhn_valid(_digits(text))
                apart = ~F.coalesce(F.get(groups, i - 2), F.lit("")).endswith(".") & ~F.get(groups, i + k - 2).endswith(".")
                of = lambda rank, kind: F.struct(
                    F.lit(rank).alias("rank"), (-k).alias("less"), F.lit(kind).alias("kind"), text.alias("text")
                )
                found = F.when(valid(_OWN_CARD), of(1, "card")).when((k == 4) & text.rlike(patterns["ip"]) & apart, of(2, "ip"))
                found = found.when((k == 3) & text.rlike(patterns["ssn"]), of(3, "ssn"))
                return found.when((k <= 3) & text.rlike(patterns["phone"]), of(4, "phone")).when(valid(_CARD), of(5, "card"))

            return _let(F.regexp_replace(F.array_join(F.slice(groups, i, k), ""), "[ .-]$", ""), judged)

        def step(state: Column, i: Column) -> Column:
            def take(best: Column) -> Column:
                whole = F.array_join(F.slice(groups, i, -best["less"]), "")
                part = _part(state["lead"], best["text"], best["kind"], F.lit(""))
                after = F.substring(whole, F.char_length(best["text"]) + 1, F.lit(1))
                taken = F.struct((i - best["less"]).alias("next"), after.alias("lead"), F.concat(state["parts"], F.array(part)).alias("parts"))
                lead = F.concat(state["lead"], F.element_at(groups, i))
                return F.when(best.isNotNull(), taken).otherwise(F.struct((i + 1).alias("next"), lead.alias("lead"), state["parts"].alias("parts")))

            ks = F.sequence(F.lit(1), F.least(F.lit(19), F.size(groups) - i + 1))
            best = F.array_min(F.filter(F.transform(ks, lambda k: candidate(i, k)), lambda c: c.isNotNull()))
            return F.when(i < state["next"], state).otherwise(_let(best, take))

        def finish(state: Column) -> Column:
            count = F.size(state["parts"])
            last = lambda p, n: _part(p["lead"], p["entity"], p["kind"], F.when(n == count - 1, state["lead"]).otherwise(""))
            none = F.array(_part(F.lit(""), run, F.lit("other"), F.lit("")))
            return F.when(count == 0, none).otherwise(F.transform(state["parts"], last))

        parts = F.array().cast("array<struct<lead:string,entity:string,kind:string,tail:string>>")
        start = F.struct(F.lit(1).alias("next"), F.lit("").alias("lead"), parts.alias("parts"))
        return F.aggregate(F.sequence(F.lit(1), F.size(groups)), start, step, finish)

    return _let(F.regexp_extract_all(run, F.lit("[0-9]+[ .-]?"), 0), parsed)


def _canonical(kind: Column, entity: Column) -> Column:
    numbers = F.when(kind == "phone", F.right(_digits(entity), F.lit(10))).otherwise(_digits(entity))
    out = F.when(kind.isin("phone", "card", "ssn"), numbers)
    return out.when(kind.isin("email", "female", "male", "name"), F.lower(entity)).otherwise(entity)


def _stream(secret: str, kind: Column, canonical: Column, attempt: int, parts: int) -> Column:
    """parts * 64 hexadecimal digits that only the key's holder can derive."""
    block = lambda i: F.sha2(F.concat_ws("\x1f", F.lit(secret), kind, canonical, F.lit(f"{attempt}.{i}")), 256)
    return F.concat(*[block(i) for i in range(parts)])


def _scrambled(canonical: Column, stream: Column) -> Column:
    """Letters for letters, digits for digits, hexadecimal for all-hexadecimal; other characters stay."""
    is_hex = canonical.rlike("^(?=.*[0-9])[0-9a-f]+$")

    def scrambled(stream: Column, is_hex: Column) -> Column:
        def one(char: Column, at: Column) -> Column:
            h = F.conv(F.substring(stream, at * 2 % 1024 + 1, F.lit(2)), 16, 10).cast("int")
            new = F.when(char.rlike("[0-9]"), (h % 10).cast("string"))
            new = new.when(char.rlike("[a-z]"), F.chr(97 + h % F.when(is_hex, 6).otherwise(26)))
            return new.when(char.rlike("[A-Z]"), F.chr(65 + h % 26)).otherwise(char)

        return F.array_join(F.transform(F.filter(F.split(canonical, ""), lambda c: c != ""), one), "")

    return _let(F.struct(stream.alias("stream"), is_hex.alias("hex")), lambda v: scrambled(v["stream"], v["hex"]))


def _numbers(stream: Column, count: Column) -> Column:
    return F.substring(F.translate(stream, "abcdef", "250419"), F.lit(1), count)


def _name(kind: Column, canonical: Column, stream: Column) -> Column:
    """Words of syllables, as many as in the name; Cyrillic for Cyrillic; a female name ends in a vowel."""

    def word(index: Column) -> Column:
        h = lambda i: F.conv(F.substring(stream, index * 20 + 2 * i + 1, F.lit(2)), 16, 10).cast("int")
        cyrillic = canonical.rlike(r"\p{IsCyrillic}")
        of = lambda i, latin, other: F.substring(
            F.when(cyrillic, other).otherwise(latin), h(i) % len(latin) + 1, F.lit(1)
        )
        consonant = lambda i: of(i, "bdfgklmnprstv", "бдфгклмнпрств")
        vowel = lambda i: of(i, "aeiou", "аеиоу")
        ending = F.when(kind == "female", F.when(cyrillic, "а").otherwise("a")).when(kind == "male", consonant(7)).otherwise("")
        longer = F.when(h(8) % 2 == 0, F.concat(consonant(4), vowel(5))).otherwise("")
        last = F.when(kind.isin("female", "male"), F.concat(F.when(kind == "male", "").otherwise(consonant(6)), ending)).otherwise("")
        return F.concat(consonant(0), vowel(1), consonant(2), vowel(3), longer, last)

    count = F.size(F.split(canonical, " "))
    return F.array_join(F.transform(F.sequence(F.lit(0), count - 1), word), " ")


def _surrogate(secret: str, attempt: int) -> Column:
    kind, canonical = F.col("kind"), F.col("canonical")
    stream = _stream(secret, kind, canonical, attempt, 1)
    size = F.char_length(canonical)
    octet = lambda i: (F.conv(F.substring(stream, 4 * i + 1, 4), 16, 10).cast("int") % 254 + 1).cast("string")
    ip = F.concat_ws(".", *[octet(i) for i in range(4)])
    body = F.concat(F.substring(canonical, 1, 1), _numbers(stream, size - 2))
    card = F.concat(body, F.filter(F.sequence(F.lit(0), F.lit(9)), lambda d: luhn_valid(F.concat(body, d.cast("string"))))[0].cast("string"))
    phone = F.concat((F.conv(F.substring(stream, 60, 1), 16, 10).cast("int") % 8 + 2).cast("string"), _numbers(stream, size - 1))
    wide = _stream(secret, kind, canonical, attempt, 16)
    return (
        F.when(kind == "ip", ip)
        .when(kind == "card", card)
        .when(kind == "phone", phone)
        .when(kind == "ssn", _numbers(stream, size))
        .when(kind.isin("female", "male", "name"), _name(kind, canonical, stream))
        .when(kind == "key", F.concat(F.lit("AKIA"), _scrambled(F.substring(canonical, 5, 16), wide)))
        .when(
            kind == "email",
            F.concat(
                _scrambled(F.regexp_extract(canonical, r"^(.*)\.", 1), wide), F.lit("."), F.regexp_extract(canonical, r"\.([^.]*)$", 1)
            ),
        )
        .otherwise(_scrambled(canonical, wide))
    )


def _rendered(kind: Column, entity: Column, surrogate: Column) -> Column:
    """The surrogate in the format of the entity: its separators, country code and case."""
    ahead = F.char_length(_digits(entity)) - F.char_length(surrogate)

    def add(state: Column, char: Column) -> Column:
        at = state["at"] - ahead
        new = F.when(char.rlike("[0-9]") & (at >= 0), F.substring(surrogate, at + 1, F.lit(1))).otherwise(char)
        after = state["at"] + F.when(char.rlike("[0-9]"), 1).otherwise(0)
        return F.struct(F.concat(state["out"], new).alias("out"), after.alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    number = F.aggregate(F.filter(F.split(entity, ""), lambda c: c != ""), start, add)["out"]
    name = F.when(entity == F.upper(entity), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    mail = F.when(entity == F.upper(entity), F.upper(surrogate)).otherwise(surrogate)
    out = F.when(kind.isin("phone", "card", "ssn"), number).when(kind.isin("female", "male", "name"), name)
    return out.when(kind == "email", mail).otherwise(surrogate)


def assigned(entities: DataFrame, secret: str, attempts: int = 40) -> DataFrame:
    """kind, canonical, surrogate for distinct entities (kind, canonical); surrogates are distinct and new."""
    spark, path = entities.sparkSession, shared_path(entities.sparkSession, "surrogates")
    known = entities.select("kind", F.col("canonical").alias("surrogate"))
    pending = entities
    done = None
    for attempt in range(attempts):
        tried = pending.withColumn("surrogate", _surrogate(secret, attempt))
        first = F.row_number().over(W.partitionBy("kind", "surrogate").orderBy("canonical"))
        free = tried.withColumn("turn", first).filter("turn = 1").drop("turn").join(known, ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done, ["kind", "surrogate"], "left_anti")
        free.select("kind", "canonical", "surrogate").write.mode("append").parquet(path)
        done = spark.read.schema("kind string, canonical string, surrogate string").parquet(path)
        left = entities.join(done, ["kind", "canonical"], "left_anti")
        if left.isEmpty():
            return done
        pending = stored(left, "pending")
    raise RuntimeError(f"no free surrogate after {attempts} attempts")


def pseudonymised(docs: DataFrame, secret: str, text: str = "text") -> DataFrame:
    """docs with the text rewritten and n_entities (replaced occurrences) added or replaced.

    A text without entities, a null or empty one included, stays as it is. Numbers of 13 to 19 digits
    count only if their check digit fits; of adjacent numbers each counts. Equal texts are rewritten once and equally.
    """
    own = F.col(f"`{text}`")
    has = F.coalesce(own.rlike(HINT) & own.rlike(ANY), F.lit(False))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), own.alias("_text"), has.alias("_has"))
    dirty = marked.filter("_has").withColumn("_key", F.sha2(F.col("_text").cast("binary"), 256))

    def occurrence(i: Column) -> Column:
        before = F.right(F.element_at("_pieces", i + 1), F.lit(40))
        before = F.when(before != "", before).when(i > 0, F.element_at("_found", i)).otherwise("")
        entity = F.element_at("_found", i + 1)
        one = lambda kind: F.when(kind == "run", _parts(entity)).otherwise(F.array(_part(F.lit(""), entity, kind, F.lit(""))))
        return F.struct(i.alias("place"), _let(_typed(before, entity), one).alias("parts"))

    found = dirty.groupBy("_key").agg(F.any_value("_text").alias("_text"))
    found = found.withColumns({"_pieces": F.split("_text", ANY, -1), "_found": F.regexp_extract_all("_text", F.lit(ANY), 0)})
    each = F.explode(F.transform(F.sequence(F.lit(0), F.size("_found") - 1), occurrence))
    found = found.select("_key", each.alias("o")).select("_key", "o.place", F.posexplode("o.parts").alias("sub", "p"))
    found = found.select("_key", "place", "sub", "p.*").withColumn("canonical", _canonical(F.col("kind"), F.col("entity")))
    found = stored(found, "occurrences")
    named = assigned(found.filter("kind <> 'other'").select("kind", "canonical").distinct(), secret)
    new = F.when(F.col("surrogate").isNull(), F.col("entity")).otherwise(_rendered(F.col("kind"), F.col("entity"), F.col("surrogate")))
    new = F.concat("lead", new, "tail").alias("new")
    rewritten = found.join(named, ["kind", "canonical"], "left").select("_key", "place", "sub", new, F.col("surrogate").isNotNull().alias("hit"))
    rewritten = rewritten.groupBy("_key").agg(
        F.sort_array(F.collect_list(F.struct("place", "sub", "new"))).alias("_new"), F.count_if("hit").alias("_hits")
    )
    out = dirty.join(rewritten, "_key")

    def filled(pieces: Column) -> Column:
        own = lambda n: F.concat(F.when(n["sub"] == 0, F.element_at(pieces, n["place"] + 1)).otherwise(""), n["new"])
        return F.concat(F.array_join(F.transform("_new", own), ""), F.element_at(pieces, -1))

    joined = _let(F.split("_text", ANY, -1), filled)

    def result(rows: DataFrame, new_text: Column, hits: Column) -> DataFrame:
        columns = [new_text.alias(c) if c == text else F.col(f"_row.`{c}`") for c in docs.columns if c != "n_entities"]
        return rows.select(*columns, hits.cast("long").alias("n_entities"))

    clean = result(marked.filter(~F.col("_has")), F.col("_text"), F.lit(0))
    return clean.unionByName(result(out, joined, F.col("_hits")))
