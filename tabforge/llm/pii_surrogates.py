"""PII: keyed surrogates for detected entities.

Entities are found by pattern. Each distinct one gets a surrogate of its own
type, format and script from a keyed hash: digits stay digits, letters stay
letters of their alphabet and case, punctuation, top-level domains and key
prefixes stay, numbers keep their Luhn remainder, and names keep title and
gender. The same entity has the same surrogate everywhere, however it is
punctuated or cased; surrogates that meet each other or a real entity are drawn
again until all are distinct. Where a format has too few values for that, its
surrogates grow.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabforge.llm.common import LAST_ID, bind, broadcast_if_small, table, text_of, written

# Titles, alphabets and what is found.
TITLES_M = "Mr|Sir|Herr|Monsieur|Señor|Sr|Signor|Господин"
TITLES_F = "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Señora|Sra|Signora|Госпожа"
TITLES_X = "Dr|Prof|Mx"
LATIN, ACCENTED, CYRILLIC, GREEK = "abcdefghijklmnopqrstuvwxyz", "àâäçéèêëíîïñóôöùûüß", "абвгдежзийклмнопрстуфхцчшщыэюя", "αβγδεζηθικλμνξοπρστυφχψω"
NAME_ENDS = {"m": {"latin": "o", "cyrillic": "н"}, "f": {"latin": "a", "cyrillic": "а"}}
PATTERNS = {
    # A domain has 127 labels at most; a loop without a bound would take a stack frame of Java for each.
    "email": r"(?<![\p{L}0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,125}\.[A-Za-z]{2,}",
    "access_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "secret": r"(?i:(?<![\p{L}0-9_])(?:password|passwd|pwd|secret|token|api_?key)\s{0,3}[=:]\s{0,3}[\"']?)[A-Za-z0-9+/_-]{8,}=*",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[0-9])",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?)?(?<![0-9])\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])|(?<![0-9.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9]|[.-][0-9])",
    "number": r"(?<![\p{L}0-9])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![\p{L}0-9])",
    "name": rf"(?<!\p{{L}})(?:{TITLES_M}|{TITLES_F}|{TITLES_X})\.? \p{{Lu}}\p{{Ll}}+(?: \p{{Lu}}\p{{Ll}}+)?",
}
FOUND = "|".join(PATTERNS.values())
#: What stays at the front of an entity of these types.
HEAD = {"phone": r"^(\+(?:[17]|[2-9][0-9])[ .-]?)", "access_key": r"^(AKIA|ASIA)", "secret": r"^([^=:]*[=:]\s*[\"']?)", "iban": r"^([A-Z]{2})", "name": rf"^((?:{TITLES_M}|{TITLES_F}|{TITLES_X})\.? )"}
#: Draws of one entity after which its surrogate grows by a character a draw: names, secrets, e-mails and phones, and types of fixed length.
PATIENCE, FIXED_PATIENCE = 4, 40
#: Phones of up to so many digits get the free values of their format one by one before they grow.
SHORT = 5


def kind_of(entity: Column) -> Column:
    """The first type whose pattern the whole entity fits; the order is that of the search."""
    kind = F.lit(None).cast("string")
    for name in reversed(PATTERNS):
        kind = F.when(entity.rlike(f"^(?:{PATTERNS[name]})$"), F.lit(name)).otherwise(kind)
    # A name's kind has its gender.
    gender = F.when(entity.rlike(rf"^(?:{TITLES_M})\.? "), "name_m").when(entity.rlike(rf"^(?:{TITLES_F})\.? "), "name_f").otherwise("name_x")
    return F.when(kind == "name", gender).otherwise(kind)


def head_of(entity: Column, kind: Column) -> Column:
    """The part of an entity that stays as it is."""
    out = F.lit("")
    for name, pattern in HEAD.items():
        out = F.when(kind.startswith(name), F.regexp_extract(entity, pattern, 1)).otherwise(out)
    return out


def bare(body: Column, kind: Column) -> Column:
    """What tells one entity from another: no punctuation between digits, no case where it doesn't matter."""
    digits = F.regexp_replace(body, "[^0-9]", "")
    return F.when(kind.isin("phone", "number", "ssn"), digits).when(kind == "email", F.lower(body)).when(kind == "iban", F.regexp_replace(body, " ", "")).otherwise(body)


def _char(seed: Column, c: Column, i: Column, hexadecimal: Column) -> Column:
    """A character of the same alphabet and case."""
    h = F.xxhash64(seed, i)
    low = F.lower(c)
    pick = lambda letters: F.substring(F.lit(letters), (F.pmod(h, F.lit(len(letters))) + 1).cast("int"), F.lit(1))
    new = F.when(low.rlike("^[a-f]$") & hexadecimal, pick("abcdef")).when(low.rlike("^[0-9]$"), pick("0123456789")).when(low.rlike("^[a-z]$"), pick(LATIN))
    new = new.when(low.rlike(f"^[{ACCENTED}]$"), pick(ACCENTED)).when(low.rlike(r"^\p{IsCyrillic}$"), pick(CYRILLIC)).when(low.rlike(r"^\p{IsGreek}$"), pick(GREEK)).otherwise(low)
    return F.when(c == low, new).otherwise(F.upper(new))


def _scrambled(seed: Column, text: Column) -> Column:
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    hexadecimal = text.rlike("^[0-9a-fA-F]{16,}$")
    return F.array_join(F.transform(chars, lambda c, i: _char(seed, c, i, hexadecimal)), "")


def luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10."""
    each = F.transform(F.reverse(F.filter(F.split(digits, ""), lambda c: c != "")), lambda c, i: F.when(
        i % 2 == 1, F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x, lambda a: a % 10)


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The keyed replacement of a bare value at its n-th draw; late draws are longer than the value."""
    seed = lambda *parts: F.sha2(F.concat_ws("|", F.lit(key), *parts), 256)
    worded = kind.startswith("name") | kind.isin("secret", "email")
    grown = F.greatest(F.lit(0), attempt - F.when(worded | (kind == "phone"), PATIENCE).otherwise(FIXED_PATIENCE))
    more = F.substr(F.regexp_replace(seed(value, attempt), F.when(worded, "[0-9]").otherwise("[a-f]"), F.lit("")), F.lit(1), grown)

    def made(s: Column) -> Column:
        plain = _scrambled(s, value)
        local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
        top = F.concat(F.lit("."), F.substring_index(domain, ".", -1))
        host = F.regexp_replace(domain, r"\.[^.]*$", "")
        email = F.concat(_scrambled(s, local), more, F.lit("@"), bind(seed(F.lit("domain"), domain), lambda d: _scrambled(d, host)), top)
        octet = lambda i: F.when(F.lit(i) == 0, F.pmod(F.xxhash64(s, F.lit(i)), F.lit(223)) + 1).otherwise(F.pmod(F.xxhash64(s, F.lit(i)), F.lit(256)))
        ip = F.concat_ws(".", *[octet(i).cast("string") for i in range(4)])
        head = F.concat(F.substring(value, 1, 1), bind(plain, lambda p: F.substr(p, F.lit(2), F.length(value) - 2)))
        number = bind(F.concat(head, more), lambda h: F.concat(h, F.pmod(luhn(value) - luhn(F.concat(h, F.lit("0"))), F.lit(10)).cast("string")))
        phone = F.concat(F.when(plain.startswith("0") & ~value.startswith("0"), F.lit("7")).otherwise(F.substring(plain, 1, 1)), F.substr(plain, F.lit(2)))
        ends = lambda g: F.when(value.rlike(r"\p{IsCyrillic}"), NAME_ENDS[g]["cyrillic"]).when(value.rlike("^[A-Za-z]+$"), NAME_ENDS[g]["latin"])
        gendered = lambda g: F.concat(F.substr(plain, F.lit(1), F.length(plain) - 1), F.coalesce(ends(g), F.substr(plain, F.length(plain))))
        out = F.when(kind == "ip", ip).when(kind == "phone", phone)
        out = out.when(kind == "name_m", gendered("m")).when(kind == "name_f", gendered("f")).otherwise(plain)
        return F.when(kind == "email", email).when(kind == "number", number).otherwise(F.concat(out, more))

    return bind(seed(kind, value, attempt.cast("string")), made)


def free_phones(phones: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    """(kind, value, replacement) for as many of ``phones`` (kind, value) of up to SHORT digits as their formats have values that are not taken.

    Values and free values are dealt to each other in keyed orders, per length:
    first the values without a leading zero, which get none, then the others.
    """
    order = lambda c: F.row_number().over(W.partitionBy(F.length(c)).orderBy(F.sha2(F.concat_ws("|", F.lit(key), F.lit("free"), c), 256)))
    digits = phones.sparkSession.range(10**SHORT).withColumn("length", F.explode(F.sequence(F.lit(1), F.lit(SHORT)))).where("id < power(10, length)")
    free = digits.select(F.expr("lpad(cast(id as string), length, '0')").alias("replacement")).join(taken.where("kind = 'phone'"), "replacement", "left_anti")
    dealt = []
    for zero in (False, True):
        pool = free if zero else free.where(~F.col("replacement").startswith("0"))
        some = phones.where((F.length("value") <= SHORT) & (F.col("value").startswith("0") == F.lit(zero)))
        pool = pool.select("replacement", F.length("replacement").alias("length"), order(F.col("replacement")).alias("at"))
        some = some.select("kind", "value", F.length("value").alias("length"), order(F.col("value")).alias("at"))
        dealt.append(written(some.join(pool, ["length", "at"]).select("kind", "value", "replacement"), "pii-free"))
        free = free.join(dealt[0], "replacement", "left_anti")
    return dealt[0].union(dealt[1])


def distinct_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, replacement) for distinct (kind, value): no two of a kind alike, none a real value of its kind.

    Of values that draw the same replacement the smallest keeps it, unless it is
    a real value or was kept before; the rest draw again until none is left.
    Short phones that are left after PATIENCE draws get the free values of their
    format, and those beyond them grow, as do all others that are left, so every
    value gets a replacement however crowded its format is.
    """
    taken, left, attempt, done = entities.select("kind", F.col("value").alias("replacement")), entities, 0, []
    while True:
        drawn = written(left.withColumn("replacement", surrogate(F.col("kind"), F.col("value"), F.lit(attempt), key)), "pii-surrogates")
        kept = [written(drawn.groupBy("kind", "replacement").agg(F.min("value").alias("value")).join(taken, ["kind", "replacement"], "left_anti")
                        .select("kind", "value", "replacement"), "pii-kept")]
        left = written(drawn.select("kind", "value").join(kept[0], ["kind", "value"], "left_anti"), "pii-left")
        taken = taken.union(kept[0].select("kind", "replacement"))
        short = left.where((F.col("kind") == "phone") & (F.length("value") <= SHORT))
        if attempt == PATIENCE and not short.isEmpty():
            kept.append(free_phones(short, taken, key))
            left = written(left.join(kept[1], ["kind", "value"], "left_anti"), "pii-left")
            taken = taken.union(kept[1].select("kind", "replacement"))
        done += kept
        if left.isEmpty():
            return reduce(DataFrame.union, done)
        attempt += 1


def _fill(body: Column, kind: Column, new: Column) -> Column:
    """The replacement in the punctuation and case of one occurrence; what a longer one has more comes last."""
    chars = F.filter(F.split(body, ""), lambda c: c != "")
    fresh = F.filter(F.split(new, ""), lambda c: c != "")
    keep = lambda c: F.when(kind.isin("phone", "number", "ssn"), ~c.rlike("[0-9]")).when(kind == "iban", c == " ").otherwise(F.lit(False))
    place = lambda acc, c: F.struct(
        F.concat(acc["text"], F.when(keep(c), c).when(F.upper(c) == F.lower(c), F.coalesce(F.get(acc["new"], acc["i"]), F.lit("")))
                 .when((kind == "email") & (c == F.upper(c)), F.upper(F.coalesce(F.get(acc["new"], acc["i"]), F.lit("")))).otherwise(F.coalesce(F.get(acc["new"], acc["i"]), F.lit("")))).alias("text"),
        F.when(keep(c), acc["i"]).otherwise(acc["i"] + 1).alias("i"), acc["new"].alias("new"))
    filled = F.aggregate(chars, F.struct(F.lit("").alias("text"), F.lit(0).alias("i"), fresh.alias("new")), place,
                         lambda a: F.concat(a["text"], F.array_join(F.slice(a["new"], a["i"] + 1, F.size(a["new"])), "")))
    return F.when(kind.isin("phone", "number", "ssn", "iban", "email"), filled).otherwise(new)


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` (doc_id, text, any more) with every entity in ``text`` replaced, and n_entities.

    Null text stays null, without entities. A text without entities is returned
    as it is. n_chars, if there, follows a changed text. Rows that repeat doc_id
    and text are treated alike; a null doc_id is like any other.
    """
    doc, row = F.coalesce("doc_id", F.lit(LAST_ID)), F.xxhash64(text_of("text"))
    found = F.regexp_extract_all(text_of("text"), F.lit(FOUND), 0)
    mentions = docs.select(doc.alias("doc"), row.alias("row"), F.explode(found).alias("entity")).distinct()
    mentions = mentions.withColumn("kind", kind_of(F.col("entity"))).withColumn("head", head_of(F.col("entity"), F.col("kind")))
    mentions = mentions.withColumn("body", F.expr("substring(entity, length(head) + 1)"))
    # A name's words are entities each, so that a family name is the same with and without the given name.
    split = F.when(F.col("kind").startswith("name"), F.split("body", " ")).otherwise(F.array("body"))
    mentions = written(mentions.select("doc", "row", "entity", "kind", "head", F.posexplode(split).alias("at", "body")).withColumn("value", bare(F.col("body"), F.col("kind"))), "pii-mentions")
    entities = written(mentions.select("kind", "value").distinct(), "pii-entities")
    replaced = mentions.join(distinct_surrogates(entities, key), ["kind", "value"])
    replaced = replaced.select("doc", "row", "entity", "head", "at", _fill(F.col("body"), F.col("kind"), F.col("replacement")).alias("new"))
    whole = replaced.groupBy("doc", "row", "entity", "head").agg(F.sort_array(F.collect_list(F.struct("at", "new"))).alias("p"))  # two words at most
    whole = whole.select("doc", "row", "entity", F.concat("head", F.array_join(F.transform("p", lambda x: x["new"]), " ")).alias("new"))
    maps = whole.groupBy("doc", "row").agg(F.map_from_entries(F.collect_list(F.struct("entity", "new"))).alias("_map"))  # of one text
    maps = broadcast_if_small(written(maps.withColumnRenamed("_map", "new"), "pii-maps"), 400)
    out = docs.select(F.struct("*").alias("in"), doc.alias("doc"), row.alias("row")).join(maps, ["doc", "row"], "left")

    def rebuilt(parts: Column) -> Column:
        entities, between = parts["entities"], parts["between"]
        return F.array_join(F.flatten(F.transform(between, lambda x, i: F.array(x, F.coalesce(F.element_at(F.col("new"), F.get(entities, i)), F.lit(""))))), "")

    parts = F.struct(F.regexp_extract_all("in.text", F.lit(FOUND), 0).alias("entities"), F.split("in.text", FOUND, -1).alias("between"))
    changed = F.col("new").isNotNull()
    out = out.withColumn("text", F.when(changed, bind(parts, rebuilt)).otherwise(F.col("in.text")))
    columns = {c: F.col("in").getField(c) for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    columns["n_entities"] = F.when(changed, F.size(F.regexp_extract_all("in.text", F.lit(FOUND), 0))).otherwise(0).cast("long")
    return out.select(*[c.alias(k) for k, c in columns.items()])


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), key="surrogates")
