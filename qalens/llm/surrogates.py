"""PII surrogates, in DataFrame functions only.

Entities (e-mail addresses in any script, IPv4 and IPv6 addresses, phone, card and social-security numbers, bank accounts,
access keys, secrets, and titled names) are found by one pattern and replaced by surrogates of the
same type and format: digits for digits, letters for letters, separators where they were, a
valid check digit where there was one, names of the title's gender in the name's script.

A surrogate is a keyed hash of the entity's canonical form, so an entity has the same one in
every document (coreference), also where it is written differently. Surrogates are checked
against each other and against every entity of the corpus; of those that collide all but one
are hashed again with the next attempt number until all are distinct. Where a format's few
values are used up, surrogates of later attempts are longer (``WIDEN``). A value of one repeated
symbol (``password: ********``) is a mask, reveals nothing and stays.

What is shuffled is entities, not texts, but for the texts that hold any. A very common entity
is joined in an ordinary join that the engine can split.

Defined results: null texts stay null, texts without entities are returned as they are;
repeated rows get the same replacements; ids are only passed through and may be null or
repeated; an empty table gives an empty result; further columns are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens.llm._shared import materialise, pack, unpack

#: The key a caller should replace; surrogates cannot be linked to entities without it.
KEY = "qalens"
MAX_ATTEMPTS = 64
#: After each so many attempts surrogates get one more letter or digit than the entity.
WIDEN = 4

# Titles that precede names, by gender ('' where they tell none), and name parts.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Mme", "Mlle", "Frau", "Señora", "Sra", "Госпожа"),
    "m": ("Mr", "Monsieur", "Herr", "Señor", "Sr", "Господин"),
    "": ("Dr", "Prof", "Доктор"),
}
FIRST = {
    "latin f": ("Ada", "Clara", "Elena", "Greta", "Ines", "Julia", "Laura", "Marta", "Nora", "Olga", "Rosa", "Vera"),
    "latin m": ("Adam", "Bruno", "David", "Emil", "Felix", "Hugo", "Jonas", "Leo", "Martin", "Oscar", "Paul", "Viktor"),
    "cyrillic f": ("Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга", "София", "Юлия"),
    "cyrillic m": ("Антон", "Борис", "Денис", "Иван", "Кирилл", "Максим", "Олег", "Павел", "Сергей", "Юрий"),
}
SYLLABLES = {
    "latin": ("ba", "ben", "cor", "da", "del", "fa", "gar", "hol", "ka", "lam", "le", "mar", "mon", "na", "per", "ra", "sen", "so", "tar", "vel"),
    "cyrillic": ("ба", "вел", "гор", "да", "зар", "ка", "лан", "ма", "мир", "на", "пет", "ра", "сол", "та", "тур", "фе"),
}

#: Letters of other scripts, and the symbols for values of symbols only.
CYRILLIC = "абвгдежзиклмнопрстуфхцчшэюя"
HAN = "天地人日月山水火木金土石田中大小上下左右东西南北"
MARKS = "!#$%&*+-.?@^_~"

_TITLE = "|".join(t for titles in TITLES.values() for t in titles)
_SPACE = r"[\s\p{Z}]"
#: A capitalised name, or an initial with another part after it.
_PART = rf"\p{{Lu}}(?:[\p{{L}}\p{{M}}'’-]+|\.?(?={_SPACE}+\p{{Lu}}))"
#: A part of a host name. Every repetition here that has no bound is possessive: the engine
#: runs those in a loop, whereas others take a stack frame a turn, which a long text exhausts.
_LABEL = r"[\p{L}\p{M}\p{N}]++(?:-++[\p{L}\p{M}\p{N}]++)*+"
_LOCAL = r"[\p{L}\p{M}\p{N}._%+-]"
_GROUP = "[0-9A-Fa-f]{1,4}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: In order: an entity is of the first type that matches it whole.
PATTERNS: dict[str, str] = {
    # the whole address in any script; the host is not a number
    "email": rf"(?<!{_LOCAL}){_LOCAL}++@(?![\d.-]*+(?![\p{{L}}\p{{M}}\p{{N}}])){_LABEL}(?:\.{_LABEL})++",
    "access_key": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "secret": r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b[ \t]{0,4}[=:][ \t]{0,4}[\"']?)"
    # a mask: one symbol, repeated to the end
    r"(?!(?<mask>[^\s\"',;\p{L}\p{M}\p{N}])\k<mask>*+(?:[\s\"',;]|$))[^\s\"',;]{6,}+",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\d]|\.\d)",
    "ip6": rf"(?<![\w:.])(?=[A-Fa-f:]{{0,38}}\d)(?:(?:{_GROUP}:){{7}}{_GROUP}"
    rf"|(?:{_GROUP}(?::{_GROUP}){{0,5}})?::(?:{_GROUP}(?::{_GROUP}){{0,5}})?)(?![\w:])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": (
        r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
        r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)"
        r"|(?<![\d-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\d-])"
        # national forms: a trunk 0 and an area code, then the number
        r"|(?<![\w+./,-])0\d{1,4}[ /-]\d{3,4} ?\d{3,5}(?![\w-])"
    ),
    "card": r"(?<![\w-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-])",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "hex_key": r"(?<![A-Za-z0-9])[0-9a-f]{32,}+(?![A-Za-z0-9])",
    "name": rf"\b(?:{_TITLE})\.?{_SPACE}++{_PART}(?:{_SPACE}++{_PART})*+",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every entity of a type has: a text without any of these has no entity.
HINTS: dict[str, str] = {
    "email": "@", "access_key": "AKIA", "secret": "[=:]", "ip": "[0-9]", "ip6": ":", "ssn": "[0-9]", "phone": "[0-9]", "card": "[0-9]",
    "account": "[0-9]", "hex_key": "[0-9]|[a-f]{32}", "name": rf"\b(?:{_TITLE})\b",
}
HINT = "|".join(dict.fromkeys(HINTS[name] for name in PATTERNS))
_SECRET_HEAD = r"^(?i:(?:password|passwd|pwd|secret|token|api[_-]?key)[ \t]*[=:][ \t]*[\"']?)"


def entity_type(entity: Column) -> Column:
    out = None
    for name, pattern in PATTERNS.items():
        test = entity.rlike(rf"^(?:{pattern})$")
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("hex_key")


def canonical_form(kind: Column, entity: Column) -> Column:
    """What two spellings of one entity share."""
    digits = F.regexp_replace(entity, r"\D", "")
    return (
        F.when(kind.isin("email", "ip6"), F.lower(entity))
        .when(kind.isin("phone", "card", "ssn"), digits)
        .when(kind == "account", F.regexp_replace(entity, " ", ""))
        .when(kind == "secret", F.regexp_replace(entity, _SECRET_HEAD, ""))
        .when(kind == "name", F.lower(F.regexp_replace(F.regexp_replace(entity, f"{_SPACE}+", " "), r"^(\S+?)\.? ", "$1 ")))
        .otherwise(entity)
    )


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def _byte(stream: Column, at: Column | int) -> Column:
    """The hash stream's number at a place, 0 to 65535 (four hex digits; places wrap)."""
    place = F.pmod(F.lit(at) if isinstance(at, int) else at, F.lit(30)) * 4 + 1
    return F.conv(F.substring(stream, place, 4), 16, 10).cast("int")


def _pick(options: Sequence[str], n: Column) -> Column:
    return F.get(F.lit(list(options)), F.pmod(n, F.lit(len(options))))


def _same_shape(text: Column, stream: Column) -> Column:
    """Digits for digits, letters for letters of the same case (hex letters where the text has
    only hex digits; Cyrillic and Han for their own, Latin for other scripts), all else as it is;
    in a text of symbols only, symbols for symbols."""
    kinds = F.struct(
        (text.rlike("^[0-9a-f]*+$") & text.rlike("[a-f]") & text.rlike("[0-9]")).alias("hex"),
        (~text.rlike(r"[\p{L}\p{M}\p{N}]")).alias("symbols"),
    )

    def shaped(kind: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            n = _byte(stream, i)
            lower = F.when(kind["hex"], _pick("abcdef", n)).otherwise(_pick("abcdefghijklmnopqrstuvwxyz", n))
            return (
                F.when(c.rlike("[0-9]"), F.pmod(n, F.lit(10)).cast("string"))
                .when(c.rlike("[a-z]"), lower)
                .when(c.rlike("[A-Z]"), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", n))
                .when(c.rlike(r"[\x00-\x7F]") & ~kind["symbols"], c)
                .when(c.rlike(r"\p{IsCyrillic}"), F.when(c.rlike(r"\p{Lu}"), _pick(CYRILLIC.upper(), n)).otherwise(_pick(CYRILLIC, n)))
                .when(c.rlike(r"\p{IsHan}"), _pick(HAN, n))
                .when(c.rlike(r"\p{Lu}"), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", n))
                .when(c.rlike(r"[\p{L}\p{M}]"), _pick("abcdefghijklmnopqrstuvwxyz", n))
                .when(c.rlike(r"\p{N}"), F.pmod(n, F.lit(10)).cast("string"))
                .when(kind["symbols"], _pick(MARKS, n))
                .otherwise(c)
            )

        return F.array_join(F.transform(F.split(text, ""), one), "")

    return _let(kinds, shaped)  # what holds for the whole text is asked once, not once a letter


def _luhn_sum(digits: Column) -> Column:
    """Sum for a check digit to come after ``digits``: every other digit doubled from the right."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, F.when(c.cast("int") * 2 > 9, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, x: total + F.coalesce(x, F.lit(0)))


def _card(digits: Column, stream: Column) -> Column:
    """Same first digit and length; a valid check digit if the original's was valid."""
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    valid = (_luhn_sum(body) + F.substring(digits, -1, 1).cast("int")) % 10 == 0
    made = F.concat(F.substring(digits, 1, 1), F.substring(_same_shape(digits, stream), F.lit(2), F.length(digits) - 2))
    return F.concat(
        made, F.when(valid, F.pmod(F.lit(10) - _luhn_sum(made) % 10, F.lit(10)).cast("string")).otherwise(F.pmod(_byte(stream, 29), F.lit(10)).cast("string"))
    )


def _person(name: Column, stream: Column, attempt: int = 0) -> Column:
    """A name for ``title name``: the title's gender, the name's script, as many parts. The
    family name has one more syllable after every two attempts, so names never run out."""
    cyrillic = name.rlike(r"\p{IsCyrillic}")
    title = F.substring_index(name, " ", 1)
    parts = F.size(F.split(name, " ")) - 1

    def of_script(script: str) -> Column:
        women, men = _pick(FIRST[f"{script} f"], _byte(stream, 0)), _pick(FIRST[f"{script} m"], _byte(stream, 0))
        female = title.isin(*[t.lower() for t in TITLES["f"]])
        either = F.when(_byte(stream, 1) % 2 == 0, women).otherwise(men)
        first = F.when(female, women).when(title.isin(*[t.lower() for t in TITLES["m"]]), men).otherwise(either)
        family = F.initcap(F.concat(*[_pick(SYLLABLES[script], _byte(stream, i)) for i in (*range(2, 6), *range(29, 29 - attempt // 2, -1))]))
        # names between the first and the last: places after those of the family
        more = F.transform(F.sequence(F.lit(6), F.greatest(parts + 3, F.lit(6))), lambda i: _pick(FIRST[f"{script} f"] + FIRST[f"{script} m"], _byte(stream, i)))
        return (
            F.when(parts > 2, F.concat_ws(" ", first, F.array_join(more, " "), family))
            .when(parts > 1, F.concat_ws(" ", first, family))
            .otherwise(family)
        )

    return F.when(cyrillic, of_script("cyrillic")).otherwise(of_script("latin"))


def surrogate(kind: Column, canonical: Column, attempt: int, key: str = KEY) -> Column:
    """The surrogate's canonical form at an attempt."""
    seed = F.concat_ws("\u0001", F.lit(key), kind, canonical, F.lit(str(attempt)))

    def made(stream: Column) -> Column:
        shaped = _same_shape(canonical, stream)
        word = F.array_join(F.transform(F.sequence(F.lit(20), F.lit(28)), lambda i: _pick("abcdefghijklmnopqrstuvwxyz", _byte(stream, i))), "")
        octets = F.concat_ws(
            ".", (240 + _byte(stream, 0) % 15).cast("string"), *[(_byte(stream, i) % 256).cast("string") for i in (1, 2, 3)],
        )
        wider_octets = [(_byte(stream, 10 + i) % 256).cast("string") for i in range(attempt // WIDEN)]
        groups = F.concat_ws(":", F.lit("2001:db8"), *[F.substring(stream, 1 + 4 * i, 4) for i in range(6)])
        # a trunk 0 stays, as a country code does
        country = F.when(canonical.startswith("0"), 1).when(F.length(canonical) > 10, F.least(F.length(canonical) - 10, F.lit(3))).otherwise(0)
        phone = F.concat(
            F.substring(canonical, F.lit(1), country),
            (2 + _byte(stream, 28) % 8).cast("string"),
            F.substring(shaped, country + 2, F.length(canonical)),
        )
        wider = range(10, 10 + attempt // WIDEN)
        digits = F.concat(F.lit(""), *[F.pmod(_byte(stream, i), F.lit(10)).cast("string") for i in wider])
        letters = F.concat(F.lit(""), *[_pick("abcdefghijklmnopqrstuvwxyz", _byte(stream, i)) for i in wider])
        return (
            # reserved domains and address ranges, and numbers never issued
            F.when(kind == "email", F.concat(F.substring_index(shaped, "@", 1), F.lit("@"), word, F.lit(".example.org")))
            .when(kind == "access_key", F.concat(F.lit("AKIA"), F.substring(shaped, 5, 16)))
            .when(kind == "ip", F.concat_ws(".", octets, *wider_octets))
            .when(kind == "ip6", groups)
            .when(kind == "ssn", F.concat(F.lit("9"), F.substring(shaped, 2, 8), digits))
            .when(kind == "phone", F.concat(phone, digits))
            .when(kind == "card", _card(canonical, stream))
            .when(kind == "account", F.concat(F.substring(canonical, 1, 2), F.substring(shaped, F.lit(3), F.length(canonical))))
            .when(kind == "name", _person(canonical, stream, attempt))
            .otherwise(F.concat(shaped, letters))
        )

    return _let(F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("\u0001")), 256)), made)


def assign_surrogates(entities: DataFrame, key: str = KEY, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """``(kind, canonical, surrogate)`` of distinct entities ``(kind, canonical)``; within a
    kind all surrogates differ from each other and from every entity (names: with any title)."""
    # entities and surrogates as they are compared: names without title, in lower case
    is_name = F.col("kind") == "name"
    entity = F.when(is_name, F.regexp_replace("canonical", r"^\S+ ", "")).otherwise(F.col("canonical"))
    own = F.when(is_name, F.lower("surrogate")).otherwise(F.col("surrogate"))
    done, pending, attempt = None, entities, 0
    while True:
        made = materialise(pending.withColumn("surrogate", surrogate(F.col("kind"), F.col("canonical"), attempt, key)), "surrogates")
        first = made.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical")).withColumn("own", own)
        taken = entities.select("kind", entity.alias("own"))
        if done is not None:
            taken = taken.union(done.select("kind", own.alias("own")))
        good = first.join(taken, ["kind", "own"], "left_anti").select("kind", "canonical", "surrogate")
        done = materialise(good if done is None else done.union(good), "assigned")
        pending = materialise(made.select("kind", "canonical").join(done, ["kind", "canonical"], "left_anti"), "pending")
        if pending.isEmpty():
            return done
        attempt += 1
        if attempt == max_attempts:
            raise ValueError(f"after {max_attempts} attempts some entities have no surrogate of their own: a format's space is used up")


def _written(kind: Column, entity: Column, own: Column) -> Column:
    """A surrogate in the format of one occurrence."""
    digits_at = F.transform(F.split(entity, ""), lambda c: c.rlike("[A-Z0-9]").cast("int"))

    def spread(marks: Column) -> Column:
        # the n-th letter or digit of the occurrence becomes the surrogate's n-th; a wider
        # surrogate's last ones come after it
        own_places = F.aggregate(marks, F.lit(0), lambda t, x: t + x)
        return F.concat(F.array_join(
            F.transform(
                F.split(entity, ""),
                lambda c, i: F.when(
                    F.get(marks, i) == 1,
                    F.substring(own, F.aggregate(F.slice(marks, F.lit(1), i + 1), F.lit(0), lambda t, x: t + x), F.lit(1)),
                ).otherwise(c),
            ),
            "",
        ), F.substring(own, own_places + 1, F.length(own)))

    # the white space between an occurrence's name parts comes between the surrogate's
    gaps = F.regexp_extract_all(entity, F.lit(f"{_SPACE}+"), F.lit(0))
    named = F.array_join(
        F.zip_with(F.split(own, " "), gaps, lambda part, gap: F.concat(F.coalesce(gap, F.lit("")), part)), ""
    )
    return (
        F.when(kind.isin("phone", "card", "ssn", "account"), _let(digits_at, spread))
        .when(kind == "secret", F.concat(F.regexp_extract(entity, _SECRET_HEAD, 0), own))
        .when(kind == "name", F.concat(F.regexp_extract(entity, rf"^[^\s\p{{Z}}]+", 0), named))
        .otherwise(own)
    )


def replace_pii(documents: DataFrame, text: str = "text", key: str = KEY, count: str | None = None) -> DataFrame:
    """The documents with every entity replaced in ``text``; ``count`` names an added column
    with the number of replacements."""
    body = F.col("_text")
    none = F.array().cast("array<string>")
    found = pack(documents, text).select(
        "_row", "_text", F.when(body.rlike(HINT), F.regexp_extract_all(body, F.lit(ANY), F.lit(0))).otherwise(none).alias("_entities")
    )
    # written once: the patterns run over each text once, not once for every use below
    found = materialise(found, "found")
    have = found.where(F.size("_entities") > 0)
    # the same text has the same entities: texts are known by 128 bits of hash
    known_by = [F.xxhash64("_text").alias("_a"), F.xxhash64(F.lit(1), "_text").alias("_b")]
    places = (
        have.select(*known_by, "_entities").dropDuplicates(["_a", "_b"])
        .select("_a", "_b", F.posexplode("_entities").alias("at", "entity"))
        .withColumn("kind", entity_type(F.col("entity")))
        .withColumn("canonical", canonical_form(F.col("kind"), F.col("entity")))
    )
    places = materialise(places, "entities")
    assigned = assign_surrogates(materialise(places.select("kind", "canonical").distinct(), "distinct-entities"), key)
    written = (
        places.join(assigned, ["kind", "canonical"])
        .select("_a", "_b", F.struct("at", _written(F.col("kind"), F.col("entity"), F.col("surrogate")).alias("new")).alias("place"))
        .groupBy("_a", "_b").agg(F.transform(F.sort_array(F.collect_list("place")), lambda x: x["new"]).alias("_new"))
    )

    def merged(pieces: Column, new: Column) -> Column:
        return F.array_join(F.zip_with(pieces, new, lambda p, n: F.concat(p, F.coalesce(n, F.lit("")))), "")

    changed = have.select("_row", "_text", *known_by).join(written, ["_a", "_b"]).select(
        "_row", merged(F.split("_text", ANY, -1), F.col("_new")).alias("_text"), F.size("_new").cast("bigint").alias("_n")
    )
    same = found.where(F.size("_entities") == 0).select("_row", "_text", F.lit(0).cast("bigint").alias("_n"))
    return unpack(same.union(changed), documents.columns, text, *([F.col("_n").alias(count)] if count else []))


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from qalens.sources.supplied import read_supplied

    return replace_pii(read_supplied(spark, sf_dir, "documents").select("doc_id", "text"), count="n_replaced")
