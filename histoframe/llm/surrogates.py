"""Personal data replaced by keyed surrogates, with DataFrame functions only.

Found are e-mail addresses, IPv4 addresses, phone numbers, card and account
numbers, social security numbers, IBANs, and names after a form of address
(with their later bare mentions in the same document). Every entity gets a
replacement of its own kind: digits for digits, letters of the same script and
case for letters, the same separators, a valid octet for an octet, a check
digit that holds where the original's did, a given name of the same
grammatical gender.

A replacement is a function of a secret key, the kind and the canonical value,
so an entity reads the same wherever it occurs. The distinct entities of the
whole table are checked for collisions: where two would share a replacement,
or a replacement is itself an entity of the table, all but one move on to
their next replacement, until all are distinct. Names and e-mail addresses get
longer with the attempts, so there is always a free one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histoframe.session import materialize

#: Attempts after which replacements without a fixed format get longer by one part, again and again.
GROWTH = 4
#: Attempts in a row that settle nobody, after which the fixed format of those left has no free value.
STALLED = 64

_MARK, _ESCAPE = "\u0001", "\u0002"

# Forms of address by the gender they tell.
ADDRESS = {
    "f": ("Mrs", "Ms", "Miss", "Lady", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "госпожа", "г-жа"),
    "m": ("Mr", "Sir", "Lord", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "господин", "г-н"),
    "n": ("Dr", "Prof", "Professor", "Doctor", "Doktor"),
}

# Letters to draw from, by script.
ALPHABETS = {
    "Greek": "αβγδεζηθικλμνξοπρστυφχψω",
    "Cyrillic": "абвгдежзиклмнопрстуфхцчшщэюя",
    "Hebrew": "אבגדהוזחטיכלמנסעפצקרשת",
    "Arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    "Hiragana": "あいうえおかきくけこさしすせそたちつてとなにぬねの",
    "Katakana": "アイウエオカキクケコサシスセソタチツテトナニヌネノ",
    "Hangul": "가나다라마바사아자차카타파하거너더러머버서어저처",
    "Han": "王李張劉陳楊黃趙吳周徐孫馬朱胡郭何高林羅鄭梁謝宋",
}
LATIN = "abcdefghijklmnopqrstuvwxyz"

# Syllables of made-up Latin names, and endings by role.
SYLLABLES = ("al", "ber", "cor", "da", "el", "fi", "gan", "hol", "is", "jo", "kel", "lu", "mar", "nor", "or", "pel", "quin", "ro", "sel", "tam", "ul", "ver", "wil", "yar", "zen", "bre", "cla", "dri", "fre", "gri", "sta", "tri")
ENDINGS = {"f": ("a", "ina", "ella", "ia"), "m": ("o", "us", "ian", "ard"), "n": ("en", "is", "ey", "in"), "s": ("son", "berg", "ley", "mann")}

_TITLE = "(?:" + "|".join(sorted((t for group in ADDRESS.values() for t in group), key=len, reverse=True)) + r")\.?"
# Runs of one class and bounded groups only: Java's matcher calls itself once for each round of an open group.
_NAME_WORD = r"\p{Lu}[\p{L}\p{M}](?:[\p{L}\p{M}'’-]*[\p{L}\p{M}])?"
NAMED = rf"(?<![\p{{L}}\p{{N}}]){_TITLE}(?: {_NAME_WORD}){{1,3}}"

# The shapes of structured entities, in order of precedence. A domain has 253 characters, so 126 dots, at most.
SHAPES = {
    "email": r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]++@(?:[\p{L}\p{N}](?:[\p{L}\p{N}-]{0,61}[\p{L}\p{N}])?\.){1,126}\p{L}{2,24}",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ip": r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![\p{L}\p{N}]|\.[0-9])",
    "card": r"(?<![\p{L}\p{N}])(?:[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{13,19})(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])",
    "phone": r"(?<![\p{L}\p{N}])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{2,4}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![\p{L}\p{N}])",
}
KINDS = (*SHAPES, "name")
_STRUCTURED = "|".join(SHAPES.values())


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _keyed(key: str, *parts: Column) -> Column:
    """Two nested SHA-256 rounds over key and parts, as hex."""
    inner = F.sha2(F.concat_ws("\u001f", F.lit(key), *parts), 256)
    return F.sha2(F.concat(F.lit(f"{key}\u001e"), inner), 256)


def _byte(seed: Column, i: Column) -> Column:
    """The i-th pseudo-random byte (from 0) that belongs to a seed."""
    block = F.sha2(F.concat_ws("|", seed, F.floor(i / 32).cast("string")), 256)
    return F.conv(block.substr((i % 32 * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _pick(options: tuple[str, ...] | str, at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (at % len(options) + 1).cast("int"))


def _other_character(c: Column, byte: Column) -> Column:
    """A digit for a digit, a letter of the same script and case for a letter, anything else itself."""
    letter = _pick(LATIN, byte)
    for script, letters in ALPHABETS.items():
        letter = F.when(c.rlike(rf"\p{{Is{script}}}"), _pick(letters, byte)).otherwise(letter)
    cased = F.when((F.upper(c) == c) & (F.lower(c) != c), F.upper(_let(letter, lambda x: x))).otherwise(letter)
    return (
        F.when(c.rlike("[0-9]"), _pick("0123456789", byte))
        .when(c.rlike("[a-z]"), _pick(LATIN, byte))
        .when(c.rlike("[A-Z]"), _pick(LATIN.upper(), byte))
        .when(c.rlike(r"\p{L}"), cased)
        .otherwise(c)
    )


def _scrambled(text: Column, seed: Column, keep_before: Column, keep_after: Column) -> Column:
    """The text with every letter and digit replaced, but for those up to ``keep_before`` and after ``keep_after`` (from 1)."""
    places = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>"))

    def at(i: Column) -> Column:
        new = F.when((i <= keep_before) | (i > keep_after), text.substr(i, F.lit(1)))
        return new.otherwise(_let(text.substr(i, F.lit(1)), lambda c: _let(_byte(seed, i - 1), lambda byte: _other_character(c, byte))))

    return F.array_join(F.transform(places, at), "")


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum of a digit string whose last digit is doubled (1) or not (0)."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = digits.substr(i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((n - i) % 2 == 1 - doubled, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def canonical(kind: Column, raw: Column) -> Column:
    """Value by which mentions of one entity are told to be the same.

    A phone number with a country code keeps it apart, before a space.
    """
    digits = F.regexp_replace(raw, "[^0-9]", "")
    code = F.regexp_extract(raw, r"^\+([0-9]{1,3})(?=[ .(-])", 1)
    phone = F.when(F.length(code) > 0, F.concat(code, F.lit(" "), digits.substr(F.length(code) + 1, F.length(digits)))).otherwise(digits)
    return (
        F.when(kind.isin("card", "ssn"), digits)
        .when(kind == "phone", phone)
        .when(kind == "iban", F.regexp_replace(raw, " ", ""))
        .when((kind == "email") & (F.length(F.lower(raw)) == F.length(raw)), F.lower(raw))
        .otherwise(raw)
    )


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """Replacement of a canonical value at an attempt; kinds of names are ``name_f``, ``_m``, ``_n`` and ``_s``."""
    longer = F.floor(attempt / GROWTH).cast("int")
    letter = F.when(kind == "email", "a").otherwise(F.lower(value.substr(F.lit(1), F.lit(1))))
    grown = F.concat(value.substr(F.lit(1), F.lit(1)), F.repeat(letter, longer), value.substr(F.lit(2), F.length(value)))
    spelt = F.when((longer > 0) & ((kind == "email") | kind.startswith("name")), grown).otherwise(value)
    return _let(spelt, lambda long: _of_seed(kind, long, longer, _keyed(key, kind, value, attempt.cast("string"))))


def _of_seed(kind: Column, value: Column, longer: Column, seed: Column) -> Column:
    """Replacement of a value's length; Latin names get ``longer`` more syllables."""
    n = F.length(value)

    def card(seed: Column) -> Column:
        def with_check(body: Column) -> Column:
            return F.concat(body, ((10 - _luhn_sum(body, 1) % 10) % 10).cast("string"))

        checked = _let(_scrambled(value.substr(F.lit(1), n - 1), seed, F.lit(1), n), with_check)
        return F.when(_luhn_sum(value, 0) % 10 == 0, checked).otherwise(_scrambled(value, seed, F.lit(1), n))

    def name(seed: Column) -> Column:
        stem = reduce(F.concat, [_pick(SYLLABLES, _byte(seed, F.lit(i))) for i in range(3)])
        more = F.transform(F.sequence(F.lit(1), longer), lambda i: _pick(SYLLABLES, _byte(seed, i + 9)))
        stem = F.when(longer > 0, F.concat(stem, F.array_join(more, ""))).otherwise(stem)
        ending = F.lit("")
        for role, endings in ENDINGS.items():
            ending = F.when(kind == f"name_{role}", _pick(endings, _byte(seed, F.lit(9)))).otherwise(ending)
        same_end = F.concat(_scrambled(value.substr(F.lit(1), n - 1), seed, F.lit(0), n), value.substr(n, F.lit(1)))
        foreign = F.when(kind == "name_s", _scrambled(value, seed, F.lit(0), n)).otherwise(same_end)
        return F.when(value.rlike(r"^[\p{IsLatin}\p{M}'’-]+$"), F.initcap(F.concat(stem, ending))).otherwise(foreign)

    def made(seed: Column) -> Column:
        octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_byte(seed, i) % 254 + 1).cast("string")), ".")
        return (
            F.when(kind == "email", _scrambled(value, seed, F.lit(0), n - F.length(F.substring_index(value, ".", -1))))
            .when(kind == "ip", octets)
            .when(kind == "card", card(seed))
            .when(kind == "iban", _scrambled(value, seed, F.lit(2), n))
            .when(kind == "phone", _scrambled(value, seed, F.instr(value, " "), n))
            .when(kind.startswith("name"), name(seed))
            .otherwise(_scrambled(value, seed, F.lit(0), n))
        )

    return _let(seed, made)


def _laid_out(kind: Column, raw: Column, made: Column) -> Column:
    """A replacement in the layout of one mention: its separators and its letter case."""
    places = F.sequence(F.lit(1), F.length(raw))

    def dense(i: Column) -> Column:
        c = raw.substr(i, F.lit(1))
        taken = F.length(F.regexp_replace(raw.substr(F.lit(1), i), "[^0-9A-Z]", ""))
        return F.when(c.rlike("[^0-9A-Z]"), c).otherwise(F.replace(made, F.lit(" "), F.lit("")).substr(taken, F.lit(1)))

    def cased(i: Column) -> Column:
        c, twin = raw.substr(i, F.lit(1)), made.substr(i, F.lit(1))
        return F.when((F.upper(c) == c) & (F.lower(c) != c), F.upper(twin)).otherwise(twin)

    return (
        F.when(kind.isin("card", "ssn", "phone", "iban"), F.array_join(F.transform(places, dense), ""))
        .when(kind == "email", F.concat(F.array_join(F.transform(places, cased), ""), made.substr(F.length(raw) + 1, F.length(made))))
        .when(kind.startswith("name") & (F.upper(raw) == raw), F.upper(made))
        .otherwise(made)
    )


def _structured_kind(raw: Column) -> Column:
    """Kind of a marked mention by the first shape that it has as a whole."""
    kind = F.lit("name")
    for name in reversed(SHAPES):
        kind = F.when(raw.rlike(f"^(?:{SHAPES[name]})$"), F.lit(name)).otherwise(kind)
    return kind


def _name_roles(named: Column) -> Column:
    """Word -> role map of a document's names after a form of address; a surname stays one."""

    def roles(mention: Column) -> Column:
        title = F.regexp_extract(mention, rf"^{_TITLE}", 0)
        bare = F.regexp_replace(title, r"\.$", "")
        gender = F.when(bare.isin(*ADDRESS["f"]), "f").when(bare.isin(*ADDRESS["m"]), "m").otherwise("n")
        parts = F.split(F.trim(mention.substr(F.length(title) + 1, F.length(mention))), " ")
        return F.transform(parts, lambda w, i: F.struct(w.alias("word"), F.when(i == F.size(parts) - 1, "s").otherwise(gender).alias("role")))

    def settled(every: Column) -> Column:
        def role_of(w: Column) -> Column:
            own = F.transform(F.filter(every, lambda e: e.word == w), lambda e: e.role)
            first = F.coalesce(*[F.when(F.array_contains(own, r), F.lit(r)) for r in ("s", "f", "m", "n")])
            return F.struct(w.alias("word"), first.alias("role"))

        return F.transform(F.array_distinct(F.transform(every, lambda e: e.word)), role_of)

    return F.map_from_entries(_let(F.flatten(F.transform(named, roles)), settled))


def marked(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with ``_parts``: the text cut so that every second part is a mention; ``_roles`` of its name words.

    A document without a digit, an at sign or a form of address has one part.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    text = F.when(text.rlike(f"[{_MARK}{_ESCAPE}]"), F.replace(F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE + "b")), F.lit(_MARK), F.lit(_ESCAPE + "a"))).otherwise(text)
    named = F.when(F.col("_text").rlike(NAMED), F.regexp_extract_all("_text", F.lit(NAMED), F.lit(0))).otherwise(F.array().cast("array<string>"))
    out = docs.withColumn("_text", text).withColumn("_roles", _name_roles(named))
    words = F.array_join(F.map_keys("_roles"), "|")
    names = F.when(F.size("_roles") > 0, F.concat(F.lit(r"|(?<![\p{L}\p{N}])(?:"), words, F.lit(r")(?![\p{L}\p{N}])"))).otherwise("")
    hit = F.regexp_replace("_text", F.concat(F.lit(_STRUCTURED), names), F.lit(f"{_MARK}$0{_MARK}"))
    busy = F.col("_text").rlike("[0-9@]") | (F.size("_roles") > 0)
    return out.withColumn("_parts", F.when(busy, F.split(hit, _MARK)).otherwise(F.array("_text"))).drop("_text")


def _kind_of(raw: Column, roles: Column) -> Column:
    def with_role(kind: Column) -> Column:
        return F.when(kind == "name", F.concat(F.lit("name_"), F.coalesce(F.element_at(roles, raw), F.lit("n")))).otherwise(kind)

    return _let(_structured_kind(raw), with_role)


def mentions(docs: DataFrame, *carried: str) -> DataFrame:
    """(kind, value) of every mention in marked documents."""
    odd = F.filter("_parts", lambda _, i: i % 2 == 1)
    each = docs.select(*carried, "_roles", F.explode(odd).alias("_raw")).select(*carried, _kind_of(F.col("_raw"), F.col("_roles")).alias("kind"), "_raw")
    return each.select(*carried, "kind", canonical(F.col("kind"), F.col("_raw")).alias("value"))


def moved_on(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, attempt) of the entities that can't have their first replacement.

    ``entities`` are distinct. Of those that share a replacement the smallest
    value keeps it; a replacement that is itself an entity is nobody's. A
    settled replacement stays taken for later attempts, so those without one
    only get fewer. It is an error where a fixed format has no free value left.
    """
    made = lambda df: df.withColumn("made", surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key))
    real = entities.select("kind", F.col("value").alias("made")).withColumn("real", F.lit(True))
    current = materialize(made(entities.withColumn("attempt", F.lit(0))), "replacements")
    left, stalled = None, 0
    while stalled < STALLED:
        owners = current.groupBy("kind", "made").agg(F.min(F.struct("attempt", "value")).alias("owner"), F.count("*").alias("n"))
        clash = owners.join(real, ["kind", "made"], "left").filter("n > 1 OR real")
        losers = current.join(clash, ["kind", "made"]).filter("real OR value <> owner.value").select("kind", "value", "attempt")
        losers = materialize(losers, "clashes")
        n = losers.count()
        left, stalled = n, stalled + 1 if n == left else 0
        if not n:
            return current.filter("attempt > 0").select("kind", "value", "attempt")
        ahead = losers.select("kind", "value", F.lit(True).alias("_moved"))
        next_one = F.col("attempt") + F.coalesce(F.col("_moved").cast("int"), F.lit(0))
        current = current.drop("made").join(ahead, ["kind", "value"], "left").select("kind", "value", next_one.alias("attempt"))
        current = materialize(made(current), "replacements")
    kinds = sorted(r.kind for r in losers.select("kind").distinct().collect())
    raise RuntimeError(f"{left} entities of {', '.join(kinds)} have no free replacement of their format")


def replace_personal_data(docs: DataFrame, key: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in the text column, and ``pii_<kind>`` counts of replaced mentions.

    A null text stays null with counts of 0; an empty one stays empty. Rows
    that repeat an id or a text are treated alike, a null id is no obstacle;
    a text of any length is searched whole, in stack space that doesn't grow.
    Columns of the table keep their names and values; counts are added, so
    the table must have no columns of their names or starting with ``_``.
    """
    cut = marked(docs, text_col)
    entities = materialize(mentions(cut).distinct(), "entities")
    late = materialize(moved_on(entities, key), "late")
    if late.isEmpty():
        placed = cut.withColumn("_late", F.lit(None).cast("map<string,int>"))
    else:
        listed = mentions(cut.withColumn("_id", F.col(id_col)), "_id").distinct()
        own = listed.join(late, ["kind", "value"]).groupBy("_id")
        own = own.agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "kind", "value"), "attempt"))).alias("_late"))
        placed = cut.join(own, F.col(id_col).eqNullSafe(F.col("_id")), "left").drop("_id")

    def replaced(roles: Column, late: Column) -> Column:
        def new(raw: Column) -> Column:
            def of_kind(kind: Column) -> Column:
                def of_value(value: Column) -> Column:
                    attempt = F.coalesce(F.element_at(late, F.concat_ws("|", kind, value)), F.lit(0))
                    made = _let(attempt, lambda a: surrogate(kind, value, a, key))
                    return _let(made, lambda made: _laid_out(kind, raw, made))

                return _let(canonical(kind, raw), of_value)

            return _let(_kind_of(raw, roles), of_kind)

        return F.array_join(F.transform("_parts", lambda raw, i: F.when(i % 2 == 1, new(raw)).otherwise(raw)), "")

    changed = _let(F.struct(F.col("_roles").alias("r"), F.col("_late").alias("l")), lambda x: replaced(x.r, x.l))
    whole = F.when(F.size("_parts") > 1, changed).otherwise(F.element_at("_parts", 1))
    spelt = F.replace(F.replace(F.col("_whole"), F.lit(_ESCAPE + "a"), F.lit(_MARK)), F.lit(_ESCAPE + "b"), F.lit(_ESCAPE))
    spelt = F.when(F.contains(F.col("_whole"), F.lit(_ESCAPE)), spelt).otherwise(F.col("_whole"))
    kinds = F.transform(F.filter("_parts", lambda _, i: i % 2 == 1), _structured_kind)

    def count(kind: str) -> Column:
        return F.size(F.filter("_kinds", lambda k: k == kind)).cast("long").alias(f"pii_{kind}")

    counts = [count(kind) for kind in KINDS]
    texts = [F.when(F.col(c).isNotNull(), spelt).alias(c) if c == text_col else F.col(c) for c in docs.columns]
    return placed.withColumn("_whole", whole).withColumn("_kinds", kinds).select(*texts, *counts)
