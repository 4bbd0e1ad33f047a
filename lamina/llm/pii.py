"""Surrogates for personal data, with DataFrame functions only.

Entities are found by one pattern of alternatives.  Each is replaced by a surrogate of its own type that depends on a
key and the entity's normalised form alone, so an entity gets the same surrogate everywhere (coreference) without any
table of entities.  Numbers keep their length and punctuation: their digits go through a keyed alternating Feistel
network, a permutation of the numbers of that length, so different numbers stay different; country codes stay, and an
IBAN's letters are permuted place by place.  Check digits are kept right: a card number that passes Luhn's test
gets a surrogate that does, and an IBAN gets new check digits.  IPv4 addresses are permuted the same way on 32 bits.  Given names are permuted within a list of their own gender and script; e-mail names, secrets
and other surnames are written from a keyed digest, and a check over all distinct entities finds surrogates that two of
them share and moves all but one to the next key until none is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, free_name, others

#: Given names by gender and script; each list is permuted within itself.
GIVEN = {
    ("f", "latin"): ["Anna", "Maria", "Laura", "Julia", "Sophie", "Emma", "Clara", "Helena", "Nina", "Olivia", "Sarah"],
    ("m", "latin"): ["Peter", "Thomas", "Daniel", "Martin", "Lucas", "David", "Andreas", "Michael", "Robert", "Stefan", "Simon"],
    ("f", "cyrillic"): ["Анна", "Мария", "Ольга", "Елена", "Наталья"],
    ("m", "cyrillic"): ["Иван", "Пётр", "Сергей", "Алексей", "Дмитрий"],
    ("f", "greek"): ["Ελένη", "Μαρία", "Σοφία", "Αννα", "Κατερίνα"],
    ("m", "greek"): ["Γιώργος", "Νίκος", "Γιάννης", "Δημήτρης", "Κώστας"],
}
#: Titles that announce a surname.
TITLES = ["Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Señora"]
#: Onsets and nuclei of which the syllables of made-up surnames consist, by script.
ONSETS = {"latin": "b br d dr f g gr h k l m n p r s t".split(), "cyrillic": "б бр д др ф г гр х к л м н п р с т".split(), "greek": "β βρ δ δρ φ γ γρ χ κ λ μ ν π ρ σ τ".split()}
NUCLEI = {"latin": "a el i or".split(), "cyrillic": "а ел и ор".split(), "greek": "α ελ ι ορ".split()}
SYLLABLES = {script: [o + n for o in ONSETS[script] for n in NUCLEI[script]] for script in ONSETS}
#: Phrases after which two capitalised words are a person's name.
CUES = ["my name is ", "My name is ", "Name: ", "name: ", "Contact: ", "contact: ", "Dear ", "Signed, ", "Ich heiße ", "Je m'appelle ", "Me llamo ", "Nombre: ", "Nom : "]
SURNAME = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_given = "|".join(n for names in GIVEN.values() for n in names)
#: Entity types in the order in which they are tried.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64})(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?=(?:[A-Z ]*\d){8})(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\w.])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?!\w)",
    "name": rf"(?=\p{{Lu}})(?<!\p{{L}})(?:(?:{'|'.join(TITLES)})\.? {SURNAME}|(?:{_given}) {SURNAME}|(?<=(?:{'|'.join(CUES)})){SURNAME} {SURNAME})(?!\p{{L}})",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every entity holds: a digit, an at sign, the start of a key, a title, given name or cue.  Most texts don't.
GATE = rf"[0-9@]|AKIA|gh[pousr]_|sk-|(?=\p{{Lu}})(?<!\p{{L}})(?:{'|'.join(TITLES)}|{_given})(?!\p{{L}})|{'|'.join(CUES)}|[0-9A-Fa-f]{{32}}"
#: Country codes of one and two digits; all others have three.
COUNTRY = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: Entities that share a surrogate are kept in a literal map; more than this many is an error of the key.
MOST_MOVED = 10_000


def kind(m: Column) -> Column:
    """The type of an entity."""
    tried = [F.when(m.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in PATTERNS.items()]
    return F.coalesce(*tried, F.lit("name"))  # a name after a cue, which is not part of the mention


def normal(m: Column, of: Column) -> Column:
    """What two mentions of one entity share: its type and its letters and digits, an address's numbers, a phone's plus."""
    plain = F.when(of.isin("email"), F.lower(m)).when(of.isin("card", "ssn", "iban"), F.regexp_replace(m, "[^0-9A-Za-z]", "")).when(of == "phone", F.regexp_replace(m, "[^0-9+]", ""))
    return F.concat(of, F.lit(":"), plain.when(of == "ip", F.regexp_replace(m, r"(?<!\d)0+(?=\d)", "")).otherwise(m))


def _once(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it."""
    return F.transform(F.array(value), f)[0]


def _number(text: Column, digits: int = 15) -> Column:
    """A non-negative number from a keyed digest."""
    return F.conv(F.substring(F.sha2(text, 256), 1, digits - 2), 16, 10).cast("long")


def feistel_digits(digits: Column, key: Column, rounds: int = 4) -> Column:
    """A keyed permutation of the digit strings of one length (2 to 36)."""
    return _once(digits, lambda d: _feistel_digits(d, key, rounds))


def _feistel_digits(digits: Column, key: Column, rounds: int) -> Column:
    cut = F.floor(F.length(digits) / 2).cast("int")
    left, right = F.substring(digits, F.lit(1), cut), F.substring(digits, cut + 1, F.length(digits))
    state = F.struct(left.alias("a"), right.alias("b"))

    def step(s: Column, r: Column) -> Column:
        a, b = s["a"], s["b"]
        power = F.pow(F.lit(10), F.length(a)).cast("decimal(38,0)")
        moved = F.pmod(a.cast("decimal(38,0)") + _number(F.concat_ws("|", key, r.cast("string"), F.length(digits).cast("string"), b)).cast("decimal(38,0)"), power)
        return F.struct(b.alias("a"), F.lpad(moved.cast("decimal(38,0)").cast("string"), F.length(a), F.lit("0")).alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), state, step, lambda s: F.concat(s["a"], s["b"]))


def with_digits(m: Column, digits: Column, places: str = "0-9") -> Column:
    """``m`` with its digits, or the characters of ``places``, replaced in order."""
    return _once(F.struct(m.alias("m"), digits.alias("digits")), lambda s: _with_digits(s["m"], s["digits"], places))


def _with_digits(m: Column, digits: Column, places: str) -> Column:
    chars = F.sequence(F.lit(1), F.length(m))
    before = lambda i: F.length(F.regexp_replace(F.substring(m, F.lit(1), i), f"[^{places}]", ""))
    at = lambda i: F.substring(m, i, F.lit(1))
    return F.array_join(F.transform(chars, lambda i: F.when(at(i).rlike(f"[{places}]"), F.substring(digits, before(i), F.lit(1))).otherwise(at(i))), "")


def shifted_letters(plain: Column, key: Column) -> Column:
    """A keyed permutation of the capitals at each place; other characters stay."""
    return _once(plain, lambda p: _shifted_letters(p, key))


def _shifted_letters(plain: Column, key: Column) -> Column:
    at = lambda i: F.substring(plain, i, F.lit(1))
    moved = lambda i: F.chr(F.pmod(F.ascii(at(i)) - 65 + _number(F.concat_ws("|", key, F.lit("letter"), i.cast("string"))), F.lit(26)) + 65)
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(plain)), lambda i: F.when(at(i).rlike("[A-Z]"), moved(i)).otherwise(at(i))), "")


def feistel_ip(m: Column, key: Column) -> Column:
    """A keyed permutation of the IPv4 addresses."""
    octet = [F.element_at(F.split(m, r"\."), i).cast("long") for i in (1, 2, 3, 4)]
    state = F.struct((octet[0] * 256 + octet[1]).alias("a"), (octet[2] * 256 + octet[3]).alias("b"))
    step = lambda s, r: F.struct(s["b"].alias("a"), F.pmod(s["a"] + _number(F.concat_ws("|", key, r.cast("string"), s["b"].cast("string"))), F.lit(65536)).alias("b"))
    parts = lambda s: F.concat_ws(".", *[p.cast("string") for x in (s["a"], s["b"]) for p in (F.floor(x / 256), F.pmod(x, F.lit(256)))])
    return F.aggregate(F.sequence(F.lit(1), F.lit(4)), state, step, parts)


def _like(m: Column, digest: Column) -> Column:
    """Secret of the same length, prefix and alphabet, from a digest of 128 hex digits."""
    prefix = F.regexp_extract(m, "^(AKIA|gh[pousr]_|sk-)", 1)
    body = F.substring(digest, F.lit(1), F.length(m) - F.length(prefix))
    return F.concat(prefix, F.when(m.rlike("[A-Z]") & ~m.rlike("^gh|^sk|[a-z]"), F.upper(body)).otherwise(body))


def _surname(digest: Column, script: str = "latin") -> Column:
    """Five of 64 syllables, told by a digest, capitalised."""
    syllable = F.array(*[F.lit(s) for s in SYLLABLES[script]])
    place = lambda i: F.pmod(F.conv(F.substring(digest, 2 * i - 1, F.lit(2)), 16, 10).cast("int"), F.lit(64)) + 1
    return F.initcap(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: F.element_at(syllable, place(i))), ""))


def _luhn_digit(body: Column) -> Column:
    """The check digit that follows the digits ``body``."""
    return _once(body, _luhn_of)


def _luhn_of(body: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(body))
    digit = lambda i: F.substring(body, i, F.lit(1)).cast("int") * F.when(F.pmod(F.length(body) - i, F.lit(2)) == 0, 2).otherwise(1)
    total = F.aggregate(F.transform(places, digit), F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d))
    return F.pmod(-total, F.lit(10)).cast("string")


def _iban_check(country: Column, account: Column) -> Column:
    """The two check digits of a country's account number."""
    return _once(F.concat(account, country, F.lit("00")), _check_of)


def _check_of(text: Column) -> Column:
    value = lambda c: F.when(c.rlike("[0-9]"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: value(F.substring(text, i, F.lit(1)))), F.lit(0), lambda a, v: F.pmod(a * F.when(v > 9, 100).otherwise(10) + v, F.lit(97)))
    return F.lpad((F.lit(98) - rest).cast("string"), 2, "0")


def _surname_like(last: Column, first: Column, digest: Column) -> Column:
    """A surname in the script of ``last``; Cyrillic ones end by the gender of the given name, or of ``last``."""
    feminine = F.when(first.isin(GIVEN["f", "cyrillic"]), True).when(first.isin(GIVEN["m", "cyrillic"]), False).otherwise(last.rlike("[ая]$"))
    slavic = F.concat(_surname(digest, "cyrillic"), F.when(feminine, "ова").otherwise("ов"))
    return F.when(last.rlike(r"\p{IsCyrillic}"), slavic).when(last.rlike(r"\p{IsGreek}"), F.concat(_surname(digest, "greek"), F.lit("ης"))).otherwise(_surname(digest))


def _given_for(name: Column, key: str) -> Column:
    """The name's image under a keyed rotation of its own list, never the name itself."""
    from hashlib import sha256

    pairs = []
    for (gender, script), names in GIVEN.items():
        shift = 1 + int(sha256(f"{key}|{gender}|{script}".encode()).hexdigest(), 16) % (len(names) - 1)
        pairs += [(n, names[(i + shift) % len(names)]) for i, n in enumerate(names)]
    return F.element_at(F.create_map(*[F.lit(x) for p in pairs for x in p]), name)


def _some_given(name: Column, digest: Column) -> Column:
    """A given name in the script of an unlisted one; Cyrillic and Latin ones that end in a vowel of women's names stay so."""
    pick = lambda names: F.element_at(F.array(*[F.lit(n) for n in names]), F.pmod(F.conv(F.substring(digest, 41, 6), 16, 10).cast("long"), F.lit(len(names))).cast("int") + 1)
    by = lambda script: F.when(name.rlike("[aаяα]$"), pick(GIVEN["f", script])).otherwise(pick(GIVEN["m", script]))
    return F.when(name.rlike(r"\p{IsCyrillic}"), by("cyrillic")).when(name.rlike(r"\p{IsGreek}"), by("greek")).otherwise(by("latin"))


def surrogate(m: Column, key: str, attempt: Column) -> Column:
    """The surrogate of one mention."""
    told = _once(kind(m), lambda of: F.struct(of.alias("of"), normal(m, of).alias("told")))
    return _once(told, lambda s: _written(m, s["of"], s["told"], key, attempt))


def _numbered(m: Column, of: Column, plain: Column, number: Column) -> Column:
    """A number in the punctuation of its mention; check digits aren't permuted but follow from the rest."""
    country = F.when(of == "phone", F.regexp_extract(plain, COUNTRY, 0)).when(of == "iban", F.substring(plain, 1, 2)).otherwise("")

    def parts(c: Column) -> Column:
        body = F.substring(plain, F.length(c) + 1, F.length(plain))
        return _once(body, lambda b: F.struct(c.alias("country"), b.alias("body"), ((of == "card") & (_luhn_digit(F.substring(b, F.lit(1), F.length(b) - 1)) == F.substring(b, -1, 1))).alias("valid")))

    def permuted(s: Column) -> Column:
        inner = F.when(s["valid"], F.substring(s["body"], F.lit(1), F.length(s["body"]) - 1)).when(of == "iban", F.substring(s["body"], F.lit(3), F.length(s["body"]))).otherwise(s["body"])
        return _once(inner, lambda i: with_digits(shifted_letters(i, number), feistel_digits(F.regexp_replace(i, "[^0-9]", ""), number)))

    def whole(s: Column) -> Column:
        return _once(permuted(s), lambda p: F.concat(s["country"], F.when(s["valid"], F.concat(p, _luhn_digit(p))).when(of == "iban", F.concat(_iban_check(s["country"], p), p)).otherwise(p)))

    return _once(_once(country, parts), lambda s: with_digits(m, whole(s), "0-9A-Z+"))


def _named(m: Column, key: str, attempt: Column) -> Column:
    first, last = F.substring_index(m, " ", 1), F.substring_index(m, " ", -1)
    digest = F.sha2(F.concat_ws("|", F.lit(key), attempt.cast("string"), F.lit("surname"), last), 256)
    title = F.when(first.rlike(f"^(?:{'|'.join(TITLES)})\\.?$"), first)
    given = F.coalesce(_given_for(first, key), title, _some_given(first, F.sha2(F.concat_ws("|", F.lit(key), F.lit("given"), first), 256)))
    return F.concat(given, F.lit(" "), _once(digest, lambda d: _surname_like(last, first, d)))


def _mailed(m: Column, digest: Column, key: str) -> Column:
    domain = F.sha2(F.concat(F.lit(key + "|domain|"), F.lower(F.substring_index(m, "@", -1))), 256)
    return F.concat(_surname_lower(digest), F.lit("."), F.substring(digest, 11, 14), F.lit("@"), F.substring(domain, 1, 12), F.lit(".example."), F.element_at(F.split(m, r"\."), -1))


def _written(m: Column, of: Column, told: Column, key: str, attempt: Column) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), attempt.cast("string"), told), 512)
    number = F.concat_ws("|", F.lit(key), attempt.cast("string"), of)
    return (
        F.when(of == "email", _once(digest, lambda d: _mailed(m, d, key)))
        .when(of == "secret", _like(m, digest))
        .when(of == "ip", feistel_ip(m, number))
        .when(of.isin("phone", "iban", "card", "ssn"), _numbered(m, of, F.substring_index(told, ":", -1), number))
        .otherwise(_named(m, key, attempt))
    )


def _surname_lower(digest: Column) -> Column:
    return F.lower(_surname(digest))


def _attempt(m: Column, moved: dict[str, int]) -> Column:
    if not moved:
        return F.lit(0)
    table = F.create_map(*[F.lit(x) for pair in moved.items() for x in pair])
    return F.coalesce(F.element_at(table, normal(m, kind(m))), F.lit(0))


def mentions(text: Column) -> Column:
    """All entities of a text in order; the long pattern runs only over texts that pass the gate."""
    return F.when(text.rlike(GATE), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct (entity) mentions of all texts."""
    return docs.select(F.explode(mentions(F.col(text_col))).alias("entity")).distinct()


def moved_entities(found: DataFrame, key: str, scratch: Scratch, tries: int = 8) -> dict[str, int]:
    """Normal forms whose surrogate another entity has too, with the attempt that sets them apart."""
    moved: dict[str, int] = {}
    m = F.col("entity")
    for _ in range(tries):
        known = found.select(normal(m, kind(m)).alias("told"), surrogate(m, key, _attempt(m, moved)).alias("written"))
        # Mentions of one entity that differ in punctuation are written in as many ways.
        of = F.substring_index("told", ":", 1)
        shared = known.groupBy(normal(F.col("written"), of).alias("plain")).agg(F.min("told").alias("stays"), F.max("told").alias("other")).where(F.col("stays") != F.col("other"))
        clashing = shared.select("other").distinct().limit(MOST_MOVED + 1).collect()
        if not clashing:
            return moved
        if len(moved) + len(clashing) > MOST_MOVED:
            raise ValueError("too many entities share a surrogate; use another key")
        for row in clashing:
            moved[row.other] = moved.get(row.other, 0) + 1
    raise ValueError("entities still share surrogates; use another key")


def _number_of(kinds: str, name: str) -> Column:
    return F.size(F.filter(kinds, lambda k: k == name)).cast("long")


def replace_entities(docs: DataFrame, key: str, text_col: str = "text", into: str = "pii") -> DataFrame:
    """The documents with a struct ``into`` (text, n_entities, counts by type); rows and other columns stay.

    Null text stays null with no entity; texts without an entity stay as they are.  Mentions that differ only in
    punctuation (or in case, for e-mail addresses) count as one entity.  Rows aren't shuffled; only distinct entities
    are, for the collision check.  Repeated rows get equal texts; null ids play no part; a column named ``into`` gives
    way.  An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    found = scratch.table(entities(docs, text_col), "entities")
    moved = moved_entities(found, key, scratch)
    scratch.drop("entities")
    text = F.col(text_col)
    kept, between, written, kinds = (free_name(docs, n) for n in ("mentions", "between", "written", "kinds"))
    has = F.size(kept) > 0
    split = docs.withColumn(kept, mentions(text)).withColumn(between, F.when(has, F.split(text, ANY, -1)))
    split = split.withColumn(written, F.transform(kept, lambda m: surrogate(m, key, _attempt(m, moved)))).withColumn(kinds, F.transform(kept, kind))
    counts = F.struct(*[_number_of(kinds, n).alias(n) for n in PATTERNS])
    joined = F.array_join(F.zip_with(between, F.concat(written, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    told = F.struct(F.when(has, joined).otherwise(text).alias("text"), F.size(kept).cast("long").alias("n_entities"), counts.alias("counts"))
    return split.select(*others(docs, into), told.alias(into))
