"""PII surrogates: every detected entity is replaced by a keyed one of its own kind.

Replacements keep format (digits for digits, letters for letters of the same case, separators as they
stood), script and gender, follow from a secret key, and are the same wherever an entity recurs, however
it is punctuated. No two entities share a replacement and none is replaced by another real entity: all
surrogates are checked against each other and against the corpus, and those that collide are drawn again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave.llm.common import stored, table, text_of

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IP = rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])"
CARD = r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![0-9])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = r"(?<![0-9A-Za-z+(])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"

#: Titles by gender, and given names by script and gender, as many in each list of a script.
TITLES = {"m": ["Mr", "Herr", "Monsieur", "Señor", "Sir", "Г-н"], "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Lady", "Г-жа"]}
GIVEN = {
    "latin": {"m": ["James", "John", "Robert", "Michael", "William", "David", "Thomas", "Peter", "Hans", "Pierre", "Carlos", "Jean"], "f": ["Mary", "Linda", "Susan", "Sarah", "Karen", "Anna", "Laura", "Julia", "Greta", "Marie", "Carmen", "Claire"]},
    "greek": {"m": ["Γιώργος", "Νίκος", "Κώστας", "Πέτρος", "Σταύρος", "Μάριος"], "f": ["Ελένη", "Σοφία", "Δήμητρα", "Ειρήνη", "Άννα", "Χριστίνα"]},
    "cyrillic": {"m": ["Иван", "Пётр", "Павел", "Игорь", "Олег", "Сергей"], "f": ["Анна", "Мария", "Ольга", "Елена", "Ирина", "Вера"]},
}
#: Syllables of made-up surnames.
SYLLABLES = {"latin": ["ba", "den", "cor", "fal", "gre", "hol", "lin", "mar", "nor", "pel", "rus", "sten", "tov", "vic", "wal", "zan"], "greek": ["βα", "γορ", "δα", "ζαν", "θεο", "καρ", "λιν", "μαν", "νο", "παν", "ρου", "στα", "τσι", "φιλ", "χατ", "ψαλ"], "cyrillic": ["ба", "вел", "гор", "дан", "зай", "ков", "лин", "мар", "нов", "пол", "рус", "сте", "тов", "фед", "чер", "шин"]}
#: Draws after which made-up names have one syllable more, and draws after which numbers whose shape has too few values leave it.
GROWS, LEAVES = 3, 8
#: First numbers of public addresses.
PUBLIC = [i for i in range(1, 224) if i not in (10, 127, 169, 172, 192)]

_title = {g: "|".join(TITLES[g]) for g in "mf"}
_first = "|".join(n for s in GIVEN.values() for g in "mf" for n in s[g])
_W = r"\p{Lu}\p{Ll}{1,30}"
NAME = rf"(?<![\p{{L}}-])(?:(?:{_title['m']}|{_title['f']})\.? {_W}(?: {_W})?|(?:{_first}) {_W})(?![\p{{L}}])"
ALL = "|".join(f"(?:{p})" for p in (EMAIL, IP, IBAN, CARD, SSN, PHONE, NAME))
KINDS = ["email", "ip", "iban", "card", "ssn", "phone", "given_m", "given_f", "surname"]
#: A text without a digit, an at sign or one of these words has no entity.
HINT = rf"[@0-9]|{_title['m']}|{_title['f']}|{_first}"


def _kind(m: Column) -> Column:
    whole = lambda p: m.rlike(f"^(?:{p})$")
    return F.when(m.contains("@"), "email").when(whole(IP), "ip").when(whole(IBAN), "iban").when(whole(CARD), "card").when(whole(SSN), "ssn").when(m.rlike("[0-9]"), "phone").otherwise("name")


def _parts(m: Column) -> Column:
    """Array of (kind, piece, value) of a match: itself, an address's local part and host, or a name's title, given name and surname with the blanks between. A local part's value is the whole address."""

    def part(kind, c, value=None):
        kind = kind if isinstance(kind, Column) else F.lit(kind)
        return F.struct(kind.alias("kind"), c.alias("piece"), F.when(kind != "plain", _canonical(kind, c) if value is None else value).alias("value"))

    title = F.regexp_extract(m, rf"^(?:(?:{_title['m']}|{_title['f']})\.? )", 0)
    words = F.split(F.substr(m, F.length(title) + 1), " ")
    males = "|".join(n for s in GIVEN.values() for n in s["m"])
    given = F.when(title != "", F.when(title.rlike(rf"^(?:{_title['m']})\b"), "given_m").otherwise("given_f")).when(words[0].rlike(f"^(?:{males})$"), "given_m").otherwise("given_f")
    name = F.when(F.size(words) == 2, F.array(part("plain", title), part(given, words[0]), part("plain", F.lit(" ")), part("surname", F.get(words, 1)))).otherwise(F.array(part("plain", title), part("surname", words[0])))
    address = F.array(part("email", F.substring_index(m, "@", 1), F.lower(m)), part("plain", F.lit("@")), part("host", F.substring_index(m, "@", -1)))
    kind = _kind(m)
    return F.when(kind == "name", name).when(kind == "email", address).otherwise(F.array(part(kind, m)))


def _canonical(kind: Column, piece: Column) -> Column:
    """What makes two mentions one entity: case of an address, punctuation of a number do not count."""
    return F.when(kind == "host", F.lower(piece)).when(kind.isin("iban", "card", "ssn", "phone"), F.regexp_replace(piece, "[^0-9A-Za-z]", "")).otherwise(piece)


def _digest(key: str, kind: Column, value: Column, turn: int, salt: str = "") -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key + salt), kind, value, F.lit(str(turn))), 512)


def _byte(digest: Column, i: Column | int) -> Column:
    at = (i if isinstance(i, Column) else F.lit(i)) % 64
    return F.conv(F.substr(digest, at * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _shaped(value: Column, digest: Column) -> Column:
    """value with each digit and letter drawn anew, a leading digit other than 0 staying so."""

    def one(c: Column, i: Column) -> Column:
        b = _byte(digest, i)
        return (
            F.when(c.rlike("^[0-9]$"), F.when((i == 0) & (c != "0"), (b % 9 + 1).cast("string")).otherwise((b % 10).cast("string")))
            .when(c.rlike("^[a-z]$"), F.char(b % 26 + 97)).when(c.rlike("^[A-Z]$"), F.char(b % 26 + 65)).otherwise(c)
        )

    return F.array_join(F.transform(F.filter(F.split(value, ""), lambda c: c != ""), one), "")


def _luhn(digits: Column, skip: int) -> Column:
    """Sum of a number's digits for the Luhn check, every second one doubled, the last `skip` left out."""
    each = F.transform(F.reverse(F.filter(F.split(digits, ""), lambda c: c != "")), lambda c, i: F.when(i < skip, 0).otherwise(F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int"))))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _remainder(number: Column) -> Column:
    """A number of digits and letters (10 to 35, as two digits) modulo 97."""
    return F.aggregate(F.filter(F.split(number, ""), lambda c: c != ""), F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(F.upper(c)) - 55) % 97).cast("int"))


def _surrogate(key: str, kind: Column, value: Column, turn: int) -> Column:
    d = _digest(key, kind, value, turn)

    def script(table):
        of = lambda x: F.array(*map(F.lit, table[x]))
        return F.when(value.rlike(r"^\p{IsCyrillic}"), of("cyrillic")).when(value.rlike(r"^\p{IsGreek}"), of("greek")).otherwise(of("latin"))

    pick = lambda list_, i: F.get(list_, (_byte(d, i) * 256 + _byte(d, i + 1)) % F.size(list_))
    below = lambda i, n: (_byte(d, i) * 256 + _byte(d, i + 1)) % n
    more = 2 * (turn // GROWS)  # so that names never run out
    made = F.initcap(F.concat(*(pick(script(SYLLABLES), i) for i in range(0, 8 + more, 2))))
    given = lambda g: F.when(F.lit(turn == 0), pick(script({s: t[g] for s, t in GIVEN.items()}), 0)).otherwise(F.concat(pick(script({s: t[g] for s, t in GIVEN.items()}), 0), F.lit("-"), F.initcap(F.concat(*(pick(script(SYLLABLES), i) for i in range(2, 8 + more, 2))))))

    octets = lambda first, n: F.concat_ws(".", F.lit(first) if isinstance(first, str) else first, *((_byte(d, i) % 254 + 1).cast("string") for i in range(4 - n, 4)))
    public, own = octets(pick(F.array(*map(F.lit, PUBLIC)), 8).cast("string"), 3), octets("10", 3)
    small = lambda x: x if turn < LEAVES else own if turn < 2 * LEAVES else public
    ip = (
        F.when(value.startswith("10."), own if turn < 2 * LEAVES else public).when(value.startswith("192.168."), small(octets("192.168", 2)))
        .when(value.rlike(r"^172\.(?:1[6-9]|2[0-9]|3[01])\."), small(octets(F.concat(F.lit("172."), (_byte(d, 8) % 16 + 16).cast("string")), 2))).when(value.startswith("127."), small(octets("127", 3))).otherwise(public)
    )

    label = F.regexp_extract(value, r"\.[a-z]+$", 0)
    # addresses grow too, after a while: there are few short ones
    longer = F.concat(*(F.lower(pick(F.array(*map(F.lit, SYLLABLES["latin"])), i)) for i in range(0, more, 2))) if more else F.lit("")
    longer_host = longer if turn > LEAVES else F.lit("")
    email = F.concat(longer, _shaped(F.substring_index(value, "@", 1), d))
    host = F.concat(longer_host, _shaped(F.substr(value, F.lit(1), F.length(value) - F.length(label)), d), label)
    drawn = _shaped(value, d)
    body = F.substr(drawn, F.lit(1), F.length(drawn) - 1)
    check = F.pmod(10 - _luhn(F.concat(body, F.lit("0")), 1) % 10, F.lit(10))
    card = F.when(_luhn(value, 0) % 10 == 0, F.concat(body, check.cast("string"))).otherwise(drawn)
    country, account = F.substr(value, F.lit(1), F.lit(2)), F.substr(drawn, F.lit(5))
    iban = F.concat(country, F.lpad((98 - _remainder(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0"), account)
    two = lambda n, i, skip=0: below(i, n) + 1 + F.when(below(i, n) + 1 >= skip, 1).otherwise(0) if skip else below(i, n) + 1
    ssn = F.concat(F.lpad(two(898, 0, 666).cast("string"), 3, "0"), F.lpad(two(99, 2).cast("string"), 2, "0"), F.lpad(two(9999, 4).cast("string"), 4, "0"))
    phone = F.concat(drawn, *((_byte(d, 40 + i) % 10).cast("string") for i in range((turn - LEAVES) // GROWS + 1 if turn >= LEAVES else 0)))
    out = {"email": email, "host": host, "ip": ip, "card": card, "iban": iban, "ssn": ssn, "phone": phone, "surname": made, "given_m": given("m"), "given_f": given("f")}
    c = F
    for k, v in out.items():
        c = c.when(kind == k, v)
    return c


def _poured(piece: Column, surrogate: Column) -> Column:
    """The surrogate's letters and digits in the places of the piece's, its punctuation kept."""
    chars = F.filter(F.split(piece, ""), lambda c: c != "")
    nth = lambda i: F.length(F.regexp_replace(F.substr(piece, F.lit(1), i + 1), "[^0-9A-Za-z]", ""))
    put = F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike("^[0-9A-Za-z]$"), F.substr(surrogate, nth(i), F.lit(1))).otherwise(c)), "")
    return F.concat(put, F.substr(surrogate, F.length(F.regexp_replace(piece, "[^0-9A-Za-z]", "")) + 1))


def _exchanged(waiting: DataFrame, key: str) -> DataFrame:
    """Hosts whose shape has no free value: each gets the next one's name, in a drawn order of those of its shape. One that is alone is left out."""
    label = F.regexp_extract("value", r"\.[a-z]+$", 0)
    shape = F.concat(F.regexp_replace(F.regexp_replace(F.substr("value", F.lit(1), F.length("value") - F.length(label)), "[a-z]", "a"), "[0-9]", "0"), label)
    hosts = waiting.filter("kind = 'host'").withColumns({"shape": shape, "drawn": _digest(key, F.col("kind"), F.col("value"), LEAVES)})
    by = W.partitionBy("shape").orderBy("drawn", "value")
    first = F.first("value").over(by.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return hosts.withColumn("surrogate", F.coalesce(F.lead("value").over(by), first)).filter("surrogate <> value").select("kind", "value", "surrogate")


def surrogate_map(entities: DataFrame, key: str, turns: int = 40) -> DataFrame:
    """kind, value, surrogate for distinct entities. Raises if collisions remain after `turns` draws.

    A surrogate is no real value of its kind, and a local part's none of a real address, but for hosts of a shape that has no
    free one: they are exchanged among themselves.
    """
    waiting = stored(entities.select("kind", "value").distinct(), "entities")
    real, done = waiting.select("kind", F.when(F.col("kind") == "email", F.substring_index("value", "@", 1)).otherwise(F.col("value")).alias("surrogate")), None
    for turn in range(turns):
        if turn == LEAVES:
            good = stored(_exchanged(waiting, key), "surrogates")
            done = good if done is None else done.unionByName(good)
            waiting = stored(waiting.join(good, ["kind", "value"], "left_anti"), "entities")
        drawn = waiting.withColumn("surrogate", _surrogate(key, F.col("kind"), F.col("value"), turn))
        lowest = drawn.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        taken = real if done is None else real.unionByName(done.select("kind", "surrogate"))
        good = stored(lowest.join(taken, ["kind", "surrogate"], "left_anti").select("kind", "value", "surrogate"), "surrogates")
        done = good if done is None else done.unionByName(good)
        waiting = stored(waiting.join(good, ["kind", "value"], "left_anti"), "entities")
        if waiting.isEmpty():
            return done
    raise RuntimeError(f"surrogates still collide after {turns} draws")


def replace_pii(docs: DataFrame, key: str = "surrogate-key") -> DataFrame:
    """doc_id, text with surrogates, and n_<kind>, how many entities of each kind were replaced, for every row.

    Account numbers keep their country and have check digits, cards theirs; social security numbers are of areas that are
    issued; private network addresses stay private; a host has one surrogate wherever it occurs, and so has an address.
    Numbers whose shape has no free value left leave it: a telephone number by a digit more, a network address into a
    wider class. Hosts of such a shape are exchanged among themselves; local parts are no real address's there either. Null and empty texts, and texts without entities, come back as they were. Repeated rows are treated
    alike; ties between entities that draw the same surrogate go to the smaller value, the other draws again. Whole texts
    are searched, however long. An empty table gives an empty result; columns but doc_id and text are left behind.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    has = F.coalesce(F.col("text").rlike(HINT) & F.col("text").rlike(ALL), F.lit(False))
    # stored, so that texts are searched once, and the others are told by what is not in it
    hit = stored(rows.filter(has).groupBy("doc_id", "text").agg(F.count("*").alias("rows")).withColumn("th", F.xxhash64("text")), "hits")

    gaps, found = F.split("text", ALL, -1), F.regexp_extract_all("text", F.lit(ALL), F.lit(0))
    part = lambda k, p, kind, piece, value: F.struct(k.alias("k"), p.alias("p"), kind.alias("kind"), piece.alias("piece"), value.alias("value"))
    flat = F.flatten(F.transform(F.arrays_zip(gaps.alias("g"), found.alias("m")), lambda x, k: F.concat(
        F.array(part(k, F.lit(-1), F.lit("plain"), x["g"], F.lit(None).cast("string"))),
        F.when(x["m"].isNull(), F.array().cast("array<struct<k:int,p:int,kind:string,piece:string,value:string>>")).otherwise(F.transform(_parts(x["m"]), lambda y, p: part(k, p, y["kind"], y["piece"], y["value"]))),
    )))
    pieces = stored(hit.select("doc_id", "th", "rows", F.explode_outer(flat).alias("x")).select("doc_id", "th", "rows", "x.*"), "pieces")
    # plain text is no key of the join
    entities, plain = pieces.filter("value IS NOT NULL"), pieces.filter("value IS NULL")
    drawn = entities.join(surrogate_map(entities, key), ["kind", "value"]).unionByName(plain.withColumn("surrogate", F.lit(None).cast("string")))
    new = F.when(F.col("surrogate").isNull(), F.col("piece")).when(F.col("kind").isin("iban", "card", "ssn", "phone"), _poured(F.col("piece"), F.col("surrogate"))).otherwise(F.col("surrogate"))
    whole = drawn.withColumn("piece", new).groupBy("doc_id", "th", "rows").agg(F.array_sort(F.collect_list(F.struct("k", "p", "piece"))).alias("all"), *(F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS))
    counts = [f"n_{k}" for k in KINDS]
    replaced = whole.select("doc_id", F.array_join(F.transform("all", lambda x: x["piece"]), "").alias("text"), *counts, F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("copy")).drop("copy")
    gone = hit.select(F.col("doc_id").alias("d"), F.col("th").alias("h"))
    rest = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("d")) & (F.xxhash64("text") == F.col("h")), "left_anti")
    kept = rest.select("doc_id", "text", *(F.lit(0).cast("bigint").alias(c) for c in counts))
    return kept.unionByName(replaced)


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(table(spark, sf_dir, "documents"))
