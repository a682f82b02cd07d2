"""Surrogates for personal data, in DataFrame functions alone.

Detected: e-mail addresses, IPv4 addresses, payment cards, IBANs, US social
security numbers, phone numbers, cloud access keys, secrets that follow their
name (``password=``, ``token = "``), and personal names after one or more
titles: any number of initials and capitalised words, with their particles.

Each detected value is replaced by a surrogate drawn from a keyed hash of its
kind and normal form, so the same value gets the same surrogate everywhere
and nobody without the key can go back.  The surrogate keeps the type and the
looks: letters stay letters of their script and case, digits digits, marks
where they are, those before an address too; cards keep their issuer digit and
a valid check digit, IBANs their country, the kinds of their characters and
valid check digits (not the rules inside a country's account number), phones
their country code, keys their prefix; e-mail domains end in ``.example`` and
addresses lie in 10.0.0.0/8, which nobody owns.  A given name is replaced by
one of the gender that the title tells and of its script, an initial by the
first letter of such a name, and a family name, the last word with its
particles, by one of its script.

Later mentions: where a text has a name after a title, its family name gets
the same surrogate wherever else the text has it as a word, and so do given
names of the text before it ("Dr. Anna Keller came. Keller spoke; Anna Keller
left.").  A given name alone stays, as any word may be one.

Collision check: over all distinct values, two values of a kind with one
surrogate, or a surrogate that is itself a value of the corpus, are found by
aggregation and join; all but the smallest value draw again until none is
left.  Values that drew again are the exceptions that documents look up; all
others are computed in place.

Defined results: null texts stay null, empty ones empty; texts without a
detected value stay byte for byte; repeated rows get equal results; a very
long text is read whole, in the task of its row; an empty table gives an empty
one; extra columns ride along, but for those named ``n_entities`` or ``kinds``,
which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged

KEY = "tessera-surrogates"

_TITLES_M = "Mr|Sir|Herr|Hr|Monsieur|Señor|Sr|Don|г-н|господин"
_TITLES_F = "Mrs|Ms|Miss|Madam|Frau|Fr|Madame|Mme|Mademoiselle|Señora|Sra|Doña|г-жа|госпожа"
_TITLES_N = "Dr|Prof|Professor"
_SECRET = r"(?i:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?"
#: marks and percent escapes before an address, which stay
_LEAD = r"(?:%[0-7][0-9A-Fa-f]|[._%+-])*+"
#: a run is read once, from its start or from the end of the match before
_EMAIL = rf"(?:(?<![A-Za-z0-9._%+-])|\G){_LEAD}[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
#: groups of four, the last of any length or with a short fifth; 4-6-5, 4-6-4; 6-13
_CARD = r"(?:\d{4}(?:[ -]?\d{4}){2}[ -]?(?:\d{4}[ -]\d{1,3}|\d{1,7})|\d{4}[ -]\d{6}[ -]\d{4,5}|\d{6}[ -]\d{13})"
_TITLE = rf"(?:{_TITLES_M}|{_TITLES_F}|{_TITLES_N})\b\.? (?:(?:{_TITLES_N})\b\.? (?=\p{{L}}))*+"
_PARTICLES = "de|del|della|delle|dei|degli|di|da|das|do|dos|du|des|la|las|le|les|los|lo|el|al|ben|bin|bint|ibn|abu|von|vom|van|der|den|het|ter|ten|zu|zum|zur|y|e|af|av"
_INITIAL = r"\p{Lu}(?![\p{L}\p{M}'’-])\.?"
_WORD = r"(?:\p{Ll}{1,4}['’-])?\p{Lu}[\p{L}\p{M}'’-]++"
_FAMILY = rf"(?:(?:{_PARTICLES}) )*+{_WORD}"
#: possessive throughout: linear, and no recursion over a long row of words
_GIVENS = rf"(?:{_INITIAL}(?: |(?<=\.)-? ?))*+"
_NAME = rf"(?=[MSHDFPг])\b{_TITLE}{_GIVENS}{_FAMILY}(?: {_GIVENS}{_FAMILY})*+"
#: one alternation, the most specific first; each starts at a word's start
PATTERN = "|".join(
    [
        r"(?=[pPtTsSaA])" + _SECRET + r"[^\s\"']{6,}+",
        _EMAIL,
        r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
        r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
        r"(?<![\d.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?![\d]|\.\d)",
        rf"(?<![\d.+-]){_CARD}(?![\d-])",
        r"(?<![\d.+-])\d{3}-\d{2}-\d{4}(?![\d-])",
        r"(?<![\d.+-])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|(?:1[ .-])?\(\d{3}\) ?\d{3}[ .-]\d{4}|(?:1[.-])?\d{3}[.-]\d{3}[.-]\d{4})(?![\d-])",
        _NAME,
    ]
)

# Surrogate names by script and gender.
_NAMES = {
    ("latin", "m"): "Adam Albert Anton Arthur Benno Carl Conrad Daniel Edwin Felix Frank Georg Henry Hugo Ivo Jonas Karl Leo Martin Max Nils Oscar Paul Peter Philip Robert Rufus Simon Theo Victor",
    ("latin", "f"): "Ada Alice Anna Bella Clara Dora Edith Elena Emma Flora Greta Hanna Helen Ida Irene Julia Karla Laura Lena Lucia Maria Martha Nina Olga Paula Rosa Sara Sophia Vera Wilma",
    ("latin", "u"): "Alex Andrea Ariel Casey Chris Dana Eden Jamie Jordan Kim Lee Luca Marion Morgan Noa Pat Quinn Robin Sam Sascha",
    ("latin", "s"): "Alder Arden Baker Berger Blum Castor Corbin Dalton Ellis Falk Fisher Garner Hale Harper Holm Keller Lang Linden Marsh Mercer Nolan Norden Parker Quist Reed Rowan Sander Stone Talbot Thorn Vance Walden Weber Winter",
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Лев Максим Олег Павел Роман Фёдор Юрий",
    ("cyrillic", "f"): "Алла Анна Вера Дарья Елена Ирина Лидия Мария Нина Ольга Раиса София Юлия Яна",
    ("cyrillic", "u"): "Валя Женя Саша Слава Шура",
    ("cyrillic", "s"): "Белов Волков Громов Зимин Лесов Морозов Орлов Полев Рыбин Снегов Соколов Туманов",
}

_LOWERS = "abcdefghijklmnopqrstuvwxyz"
_CYRILLIC = "абвгдежзийклмнопрстуфхцчшщэюя"


def _title_of(titles: Column) -> Column:
    """The gender that the first title tells."""
    return F.when(titles.rlike(rf"^({_TITLES_M})\b"), "m").when(titles.rlike(rf"^({_TITLES_F})\b"), "f").otherwise("u")


def _pieces(entity: Column, before: Column) -> Column:
    """(lit, kind, value) of a match: fixed text, then a value to replace."""
    def piece(lit, kind, value):
        return F.struct(lit.alias("lit"), kind.alias("kind"), value.alias("value"))

    title = F.regexp_extract(entity, f"^{_TITLE}(?=\\p{{L}})", 0)
    # initials and words, and what stands between them; step by step, so that no name is read once a word
    token = f"{_FAMILY}|{_INITIAL}"
    read = F.transform(
        F.array(F.struct(title.alias("title"), F.substr(entity, F.length(title) + 1).alias("rest"))),
        lambda h: F.struct(
            F.concat(before, h["title"]).alias("lit"), F.concat(F.lit("name_"), _title_of(h["title"])).alias("given"),
            F.regexp_extract_all(h["rest"], F.lit(token), F.lit(0)).alias("t"), F.split(h["rest"], token, -1).alias("b"),
        ),
    )
    named = F.flatten(F.transform(read, lambda h: F.transform(
        F.arrays_zip(h["t"].alias("t"), F.slice(h["b"], F.lit(1), F.size(h["t"])).alias("b")),
        lambda x, i: piece(
            F.when(i == 0, h["lit"]).otherwise(x["b"]), F.when(i == F.size(h["t"]) - 1, F.lit("name_s")).otherwise(h["given"]), x["t"]
        ),
    )))
    secret = F.regexp_extract(entity, f"^({_SECRET})", 1)
    mail = entity.contains("@")
    lead = F.when(mail, F.regexp_extract(entity, f"^{_LEAD}", 0)).otherwise("")
    kind = (
        F.when(mail, "email")
        .when(entity.rlike(r"^(AKIA|ASIA)[A-Z0-9]{16}$"), "cloud_key")
        .when(entity.rlike(r"^[A-Z]{2}[0-9]{2}"), "iban")
        .when(entity.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip")
        .when(entity.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(entity.rlike(f"^{_CARD}$"), "card")
        .otherwise("phone")
    )
    return (
        F.when(F.length(secret) > 0, F.array(piece(F.concat(before, secret), F.lit("secret"), F.substr(entity, F.length(secret) + 1))))
        .when(F.length(title) > 0, named)
        .otherwise(F.array(piece(F.concat(before, lead), kind, F.substr(entity, F.length(lead) + 1))))
    )


#: The country codes of the numbering plan, as one pattern.
_COUNTRY = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"


def _norm(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    # what follows the country code, or the 1 before an area code
    national = F.when(value.startswith("+"), F.regexp_extract(digits, f"^{_COUNTRY}(.+)$", 1)).otherwise(
        F.when(F.length(digits) == 11, F.substring(digits, 2, 10)).otherwise(digits)
    )
    return (
        F.when(kind == "phone", national)
        .when(kind.isin("card", "ssn"), digits)
        .when(kind == "iban", F.regexp_replace(value, " ", ""))
        .when(kind == "email", F.lower(value))
        .when(kind.startswith("name"), F.regexp_replace(F.lower(value), "[.]$", ""))
        .otherwise(value)
    )


def _draw(seed: Column, at, n) -> Column:
    return F.pmod(F.xxhash64(seed, at), F.lit(n) if isinstance(n, int) else n).cast("int")


def _pick(alphabet: str, seed: Column, at) -> Column:
    return F.substring(F.lit(alphabet), _draw(seed, at, len(alphabet)) + 1, F.lit(1))


def _alike(value: Column, seed: Column, keep: Column | None = None) -> Column:
    """``value`` with letters and digits redrawn, script and case kept; the
    first ``keep`` characters stay."""
    hexadecimal = value.rlike("^[0-9a-f]+$")

    def one(c, i):
        new = (
            F.when(c.rlike("[0-9]"), _pick("0123456789", seed, i))
            .when(c.rlike("[a-f]") & hexadecimal, _pick("abcdef", seed, i))
            .when(c.rlike("[a-z]"), _pick(_LOWERS, seed, i))
            .when(c.rlike("[A-Z]"), _pick(_LOWERS.upper(), seed, i))
            .when(c.rlike(r"\p{IsCyrillic}") & c.rlike(r"\p{Lu}"), _pick(_CYRILLIC.upper(), seed, i))
            .when(c.rlike(r"\p{IsCyrillic}"), _pick(_CYRILLIC, seed, i))
            .when(c.rlike(r"\p{Lu}"), _pick(_LOWERS.upper(), seed, i))
            .when(c.rlike(r"\p{L}"), _pick(_LOWERS, seed, i))
            .otherwise(c)
        )
        return new if keep is None else F.when(i < keep, c).otherwise(new)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _luhn_sum(digits: Column, odd: Column) -> Column:
    """Luhn sum of a digit string, doubling positions with the parity ``odd``
    (0-based from the left)."""
    def add(acc, x):
        d = x["d"]
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when(x["i"] % 2 == odd, twice).otherwise(d)

    marked = F.transform(F.split(digits, ""), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))
    return F.aggregate(marked, F.lit(0), add)


def _card(norm: Column, seed: Column) -> Column:
    body = F.expr("1")  # the issuer digit stays
    drawn = F.substring(_alike(norm, seed, body), F.lit(1), F.length(norm) - 1)
    check = F.pmod(10 - F.pmod(_luhn_sum(drawn, F.pmod(F.length(drawn) + 1, F.lit(2))), F.lit(10)), F.lit(10))
    return F.concat(drawn, check.cast("string"))


def _iban(norm: Column, seed: Column) -> Column:
    """Country and drawn account characters under valid check digits: the
    account, the country and 00, letters as 10 to 35, modulo 97."""
    account = F.substr(_alike(norm, seed, F.expr("4")), F.lit(5))
    country = F.substring(norm, 1, 2)

    def step(acc, c):
        return F.when(c.rlike("[0-9]"), (acc * 10 + c.try_cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)

    rest = F.aggregate(F.split(F.concat(account, country, F.lit("00")), ""), F.lit(0), lambda acc, c: F.coalesce(step(acc, c), acc))
    return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), account)


def _name(kind: Column, norm: Column, seed: Column, attempt: Column) -> Column:
    script = F.when(norm.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    out = F.lit(None).cast("string")
    for (of, gender), names in _NAMES.items():
        choice = F.element_at(F.array(*map(F.lit, names.lower().split())), _draw(seed, F.lit(0), len(names.split())) + 1)
        out = F.when((script == of) & (kind == f"name_{gender}"), choice).otherwise(out)
    # once a list is used up the name grows by a drawn syllable at each attempt
    letters = F.when(script == "cyrillic", F.concat(_pick("бвгдклмнпрст", seed, F.lit(1)), _pick("аеио", seed, F.lit(2)))).otherwise(
        F.concat(_pick("bdfgklmnprst", seed, F.lit(1)), _pick("aeiou", seed, F.lit(2)))
    )
    more = F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(attempt, F.lit(1))), lambda k: F.concat(letters, _pick("lmnrs", seed, k + 2))), "")
    return F.when(attempt > 0, F.concat(out, more)).otherwise(out)


def _seed(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, norm, attempt.cast("string")), 256)


def _canonical(kind: Column, norm: Column, attempt: Column, seed: Column) -> Column:
    """The surrogate of a value's normal form."""
    octets = F.concat_ws(".", F.lit("10"), *(_draw(seed, F.lit(k), 256).cast("string") for k in range(3)))
    local, domain = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
    labels = F.substring_index(domain, ".", 1)
    mail = F.concat(_alike(local, seed), F.lit("@"), _alike(labels, F.concat(seed, F.lit("d"))), F.lit(".example"))
    return (
        F.when(kind == "email", mail)
        .when(kind == "ip", octets)
        .when(kind == "card", _card(norm, seed))
        .when(kind == "phone", _alike(norm, seed))
        .when(kind == "iban", _iban(norm, seed))
        .when(kind == "cloud_key", _alike(norm, seed, F.expr("4")))
        .when(kind.startswith("name"), _name(kind, norm, seed, attempt))
        .otherwise(_alike(norm, seed))
    )


def _poured(kind: Column, value: Column, canonical: Column) -> Column:
    """A canonical surrogate in the format of the value found; the digits of a
    phone number before its national part, its country code, stay."""
    before = F.length(F.regexp_replace(value, "[^A-Za-z0-9]", "")) - F.length(canonical)

    def at(c, i):
        n = F.length(F.regexp_replace(F.substring(value, F.lit(1), i + 1), "[^A-Za-z0-9]", "")) - before
        return F.when(c.rlike("[A-Za-z0-9]") & (n > 0), F.substring(canonical, n, F.lit(1))).otherwise(c)

    spread = F.array_join(F.transform(F.split(value, ""), at), "")
    initial = F.concat(F.upper(F.substring(canonical, 1, 1)), F.when(value.endswith("."), ".").otherwise(""))
    name = (
        F.when(value.rlike(r"^\p{Lu}\.?$"), initial)
        .when(F.upper(value) == value, F.upper(canonical))
        .otherwise(F.initcap(canonical))
    )
    return F.when(kind.isin("card", "phone", "ssn", "iban"), spread).when(kind.startswith("name"), name).otherwise(canonical)


def _with(column: str, name: str, of) -> Column:
    """An array of structs with one more field, a function of the struct.
    Step by step no expression is written out more than once."""
    return F.transform(column, lambda p: p.withField(name, of(p)))


def _found(docs: DataFrame) -> DataFrame:
    """``docs`` with __parts, the array of (lit, kind, value, norm) up to the
    last match, null without one, and __tail, the text after it."""
    # without a digit, @, = or : and without a key's prefix only names can match
    other = F.col("text").rlike("[0-9@=:]") | F.col("text").contains("AKIA") | F.col("text").contains("ASIA")
    held = F.when(other, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).otherwise(
        F.regexp_extract_all("text", F.lit(_NAME), F.lit(0))
    )
    pairs = F.arrays_zip(F.col("__ents").alias("e"), F.slice("__segs", F.lit(1), F.size("__ents")).alias("s"))
    return (
        docs.withColumn("__ents", held)
        .withColumn("__segs", F.when(F.size("__ents") > 0, F.split("text", PATTERN, -1)))
        .withColumn("__parts", F.when(F.size("__ents") > 0, F.flatten(F.transform(pairs, lambda x: _pieces(x["e"], x["s"])))))
        .withColumn("__tail", F.element_at("__segs", -1))
        .drop("__ents", "__segs")
        .withColumn("__parts", _with("__parts", "norm", lambda p: _norm(p["kind"], p["value"])))
    )


def collisions(values: DataFrame, key: str) -> DataFrame:
    """(kind, norm) of the values (kind, norm, attempt) that must draw again."""
    drawn = staged(
        values.withColumn("seed", _seed(F.col("kind"), F.col("norm"), F.col("attempt"), key))
        .withColumn("sur", _canonical(F.col("kind"), F.col("norm"), F.col("attempt"), F.col("seed"))).drop("seed"),
        "pii-drawn",
    )
    shared = drawn.groupBy("kind", "sur").agg(F.min("norm").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = drawn.join(shared, ["kind", "sur"]).filter("norm <> first").select("kind", "norm")
    real = drawn.join(values.select("kind", F.col("norm").alias("sur")), ["kind", "sur"], "left_semi").select("kind", "norm")
    return again.unionByName(real).distinct()


def attempts(found: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, norm, attempt) of the distinct values (kind, norm), free of
    collisions."""
    values = found.select("kind", "norm").distinct().withColumn("attempt", F.lit(0))
    while True:
        values = staged(values, "pii-values")
        again = staged(collisions(values, key), "pii-again")
        if not again.limit(1).count():
            return values
        values = values.join(again.withColumn("__more", F.lit(1)), ["kind", "norm"], "left").select(
            "kind", "norm", (F.col("attempt") + F.coalesce("__more", F.lit(0))).alias("attempt")
        )


_WORD_START, _WORD_END = r"(?<![\p{L}\p{M}\p{N}_'’-])", r"(?![\p{L}\p{M}\p{N}_]|[-’']\p{L}{2})"


def _mentions(text: Column) -> Column:
    """``text``, already with surrogates, where later mentions of the names in
    __parts get theirs: given names before a family name of the text, then the
    family names.  No surrogate is a value of the corpus, so none is replaced."""
    names = F.filter("__parts", lambda p: p["kind"].startswith("name") & (F.length(p["value"]) > 2))
    told = F.array_distinct(F.transform(names, lambda p: F.struct(
        (p["kind"] == "name_s").alias("family"), F.regexp_extract(p["value"], rf"({_WORD})$", 1).alias("word"), p["poured"].alias("new")
    )))
    told = F.filter(told, lambda n: F.length(n["word"]) > 1)
    particles = f"(?:(?:{_PARTICLES}) )*+"
    words = lambda family: F.array_join(F.array_distinct(F.transform(F.filter(told, lambda n: n["family"] == family), lambda n: n["word"])), "|")
    behind = F.concat(F.lit(r"(?= (?:(?:"), F.when(words(False) == "", F.lit("(?!)")).otherwise(words(False)), F.lit(rf"|{_INITIAL}) )*+{particles}(?:"), words(True), F.lit(f"){_WORD_END})"))
    rules = F.transform(told, lambda n: F.struct(
        (~n["family"]).alias("given"),
        F.concat(F.lit(_WORD_START), F.when(n["family"], F.lit(particles)).otherwise(F.lit("")), n["word"], F.lit(_WORD_END), F.when(n["family"], F.lit("")).otherwise(behind)).alias("p"),
        n["new"].alias("new"),
    ))
    first = F.concat(F.filter(rules, lambda r: r["given"]), F.filter(rules, lambda r: ~r["given"]))
    replaced = F.aggregate(first, text, lambda acc, r: F.regexp_replace(acc, r["p"], r["new"]))
    return F.when(F.size(told) > 0, replaced).otherwise(text)


def surrogates(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with ``text`` pseudonymised, and n_entities and kinds (sorted
    distinct kinds found)."""
    text_key = [F.xxhash64("text").alias("__t1"), F.xxhash64(F.lit(1), "text").alias("__t2")]
    # the values of each text, read once for the collision check and its exceptions
    found = staged(
        _found(docs.select("text")).filter("__parts is not null")
        .select(*text_key, F.explode("__parts").alias("p"))
        .select("__t1", "__t2", F.col("p.kind").alias("kind"), F.col("p.norm").alias("norm")).distinct(),
        "pii-found",
    )
    redrawn = attempts(found, key).filter("attempt > 0")
    # exceptions of each text that has any: kind and normal form to attempt
    uses = (
        found.join(redrawn, ["kind", "norm"])
        .groupBy("__t1", "__t2")
        .agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\x1f", "kind", "norm"), "attempt"))).alias("__again"))
    )
    joined = docs.withColumns({"__k1": F.xxhash64("text"), "__k2": F.xxhash64(F.lit(1), "text")}).join(
        staged(uses, "pii-exceptions"), (F.col("__k1") == F.col("__t1")) & (F.col("__k2") == F.col("__t2")), "left"
    )

    def attempt(p):
        again = F.try_element_at("__again", F.concat_ws("\x1f", p["kind"], p["norm"]))
        return F.coalesce(again, F.lit(0))

    # step by step, so that no expression is written out more than once
    steps = {
        "attempt": attempt,
        "seed": lambda p: _seed(p["kind"], p["norm"], p["attempt"], key),
        "canonical": lambda p: _canonical(p["kind"], p["norm"], p["attempt"], p["seed"]),
        "poured": lambda p: _poured(p["kind"], p["value"], p["canonical"]),
        "new": lambda p: F.concat(p["lit"], p["poured"]),
    }
    out = _found(joined)
    for name, step in steps.items():
        out = out.withColumn("__parts", _with("__parts", name, step))
    new = F.concat(F.array_join(F.transform("__parts", lambda p: p["new"]), ""), F.col("__tail"))
    new = _mentions(new)
    kinds = F.array_sort(F.array_distinct(F.transform("__parts", lambda p: p["kind"])))
    names = [c for c in docs.columns if c not in ("n_entities", "kinds")]
    return (
        out.withColumn("n_entities", F.coalesce(F.size("__parts"), F.lit(0)).cast("long"))
        .withColumn("n_entities", F.greatest("n_entities", F.lit(0)))
        .withColumn("kinds", F.coalesce(kinds, F.array().cast("array<string>")))
        .withColumn("text", F.when(F.col("__parts").isNotNull(), new).otherwise(F.col("text")))
        .select(*names, "n_entities", "kinds")
    )
