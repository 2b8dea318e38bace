"""Operator 7: personal data and secrets replaced by surrogates (native).

One pattern finds mail addresses, phone numbers, addresses of machines,
card and account numbers, social security numbers, secrets and person names.
Each entity becomes a surrogate of its own type and format: separators,
letter case, script, country code, issuer digit and check-digit validity
stay, first names stay within their gender and script, surnames keep script
and ending.  A surrogate is drawn from a keyed SHA-256 of type, canonical
form and attempt, so one entity has one surrogate in the whole corpus (also
a phone number written in another format, or a surname met again without its
first name), and nobody without the key can invert it.

Collision checks: the dictionary of all entities is gathered and two
entities with one surrogate, or a surrogate that is itself an entity of the
corpus, are drawn again with the next attempt until none is left.  Only
those exceptions are stored; every other surrogate follows from its text.

All of it is DataFrame functions: no Python runs on the executors.  Texts
are never shuffled: only the distinct entities are, and a row that holds an
exception finds its attempts by the hash of its text.

Defined results: a NULL text stays NULL, a text without entities stays
unchanged byte by byte, repeated rows get equal texts, an empty table gives
an empty result, all other columns are kept.  Texts are never cut.
"""

from __future__ import annotations

import hashlib
import hmac

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainyard.llm.common import fresh, stored

# Titles, first names by script and gender, syllables of surnames,
# prefixes that name a key's issuer, alphabets.
TITLES = ["Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Mme",
          "Señor", "Señora"]
FIRST_NAMES = {
    "latin male": ["James", "John", "Robert", "Michael", "William", "David", "Richard", "Thomas",
                   "Charles", "Daniel", "Matthew", "Peter", "Hans", "Jürgen", "Pierre", "Carlos"],
    "latin female": ["Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan",
                     "Jessica", "Sarah", "Karen", "Nancy", "Alice", "Ursula", "Monique",
                     "Carmen", "Lucía"],
    "cyrillic male": ["Иван", "Пётр", "Сергей", "Дмитрий", "Алексей", "Николай"],
    "cyrillic female": ["Анна", "Мария", "Елена", "Ольга", "Наталья", "Татьяна"],
}
SYLLABLES = {
    "latin": ["ba", "bel", "bri", "cor", "da", "del", "dor", "fa", "fen", "gar", "ha", "hol", "jan",
              "kel", "la", "lin", "mar", "mo", "nel", "nor", "per", "ra", "rin", "ros", "sel",
              "sta", "ter", "tol", "va", "ver", "win", "zel"],
    "cyrillic": ["ба", "бел", "вор", "гор", "да", "дол", "жар", "за", "ка", "кол", "ла", "лес",
                 "ма", "мир", "но", "ор", "пет", "ра", "сан", "тар"],
}
KEY_PREFIX = "^(?:AKIA|gh[pousr]_|sk-|eyJ)"
LOWER = "abcdefghijklmnopqrstuvwxyz"
CYRILLIC = "абвгдежзиклмнопрстуфхцчшщэюя"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_WORD = r"\p{Lu}[\p{L}'’-]++"
_GIVEN = "|".join(sorted(sum(FIRST_NAMES.values(), []), key=lambda n: (-len(n), n)))
#: Entities in the order of preference where several match at one place.  A
#: candidate starts where no character of its own kind precedes it, and runs
#: are possessive, so that matching is linear in the text.
KINDS = [
    ("EMAIL", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@(?:[\p{L}\p{N}-]{1,63}+\.)++"
              r"\p{L}{2,24}+"),
    ("SECRET", r"(?=[tspaTSPA])(?<![\p{L}\p{N}])"
               r"(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)"
               r"[\"']?[ \t]{0,3}[=:][ \t]{0,3}[\"']?[A-Za-z0-9_./+=~-]{8,}+"),
    ("KEY", r"(?=[0-9a-gsA])(?<![A-Za-z0-9_])(?:AKIA[0-9A-Z]{16}+|gh[pousr]_[A-Za-z0-9]{36,}+"
            r"|sk-[A-Za-z0-9_-]{20,}+|eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"
            r"|(?=[a-f]{0,63}[0-9])[0-9a-f]{32,64}+)(?![A-Za-z0-9_])"),
    ("IBAN", r"(?=[A-Z]{2}\d)(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?"
             r"(?![\p{L}\p{N}])"),
    ("IP", r"(?=\d)(?<![\p{L}\p{N}.])(?:%s\.){3}%s(?!\d|\.\d)" % (_OCTET, _OCTET)),
    ("IPV6", r"(?=[0-9A-Fa-f]{1,4}+:)(?<![\p{L}\p{N}:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\p{L}\p{N}:])"
             # shortened: the first group whole and with a digit, so that no name::name is one
             r"|(?=[0-9A-Fa-f]{4}:)(?=[A-Fa-f]{0,3}[0-9])(?<![\p{L}\p{N}:.])"
             r"[0-9A-Fa-f]{4}(?::[0-9A-Fa-f]{1,4}){0,5}::"
             r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}(?![\p{L}\p{N}:])"),
    ("SSN", r"(?=\d)(?<![\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{N}-])"),
    ("CARD", r"(?=\d)(?<![\p{N}.])(?:\d{13,19}+|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}[ -]\d{6}[ -]\d{5})"
             r"(?!\d)"),
    ("PHONE", r"(?=\+)(?<![\p{N}+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)"
              r"|(?=\()(?<![\p{N}+])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)"
              r"|(?=\d)(?<![\p{N}.+-])\d{3}([.-])\d{3}\2\d{4}(?![.-]?\p{N})"
              # with blanks: as numbers are dialled, and not within a row of numbers
              r"|(?=[2-9])(?<![\p{N}.+-])(?<!\p{N} )[2-9]\d{2} [2-9]\d{2} \d{4}(?![ .-]?\p{N})"),
    ("NAME", r"(?=\p{Lu})(?<![\p{L}\p{N}])(?:(?:%s)\.? %s(?: %s)?|(?:%s) %s)"
             % ("|".join(sorted(TITLES, key=lambda t: -len(t))), _WORD, _WORD, _GIVEN, _WORD)),
]
#: Where any kind can start, by what its own look-behind and first character
#: allow: outside words; with a digit, + or ( straight after a letter; a key also
#: after a letter or digit that is not ASCII.  Other places fail at once.
STARTS = (r"(?>(?=[0-9+(])(?<!\p{N})|(?<![A-Za-z0-9])(?:(?<![\p{L}\p{N}])(?=[\p{L}\p{N}._%+-])"
          r"|(?<=[^\x00-\x7F])(?=[0-9a-gsA])))")
ENTITY = STARTS + "(?:%s)" % "|".join(f"(?:{p})" for _, p in KINDS)
#: Draws of one entity before the domain of its format counts as exhausted.
MAX_ATTEMPTS = 64


def _renamed(key: str) -> dict[str, str]:
    """First name -> its surrogate: a keyed cycle within each script and gender."""
    out = {}
    for names in FIRST_NAMES.values():
        order = sorted(names, key=lambda n: hmac.new(key.encode(), n.encode(), "sha256").digest())
        out.update(zip(order, order[1:] + order[:1]))
    return out


def _kind(m: Column) -> Column:
    """The first kind whose whole pattern the entity is."""
    out = F.lit("NAME")
    for kind, pattern in reversed(KINDS[:-1]):
        # \1 and \2 count the groups of the joint pattern
        own = pattern.replace(r"\2", r"\1")
        out = F.when(m.rlike(f"^(?:{own})$"), kind).otherwise(out)
    return out


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"\D", "")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _parts(m: Column, kind: Column) -> Column:
    """(kind, text) of the entity's parts: a name's words, else the entity."""
    given = F.array(*[F.lit(n) for names in FIRST_NAMES.values() for n in names])
    titles = F.array(*[F.lit(t) for t in TITLES])

    def word(w: Column) -> Column:
        what = (F.when(F.array_contains(titles, F.regexp_replace(w, r"\.$", "")), "TITLE")
                .when(F.array_contains(given, w), "FIRST").otherwise("SURNAME"))
        return F.struct(what.alias("kind"), w.alias("m"))

    return F.when(kind == "NAME", F.transform(F.split(m, " "), word)).otherwise(
        F.array(F.struct(kind.alias("kind"), m.alias("m"))))


def _canonical(p: Column) -> Column:
    """What is the same for all spellings of one entity."""
    kind, m = p["kind"], p["m"]
    digits = _digits(m)
    return (F.when(kind == "PHONE", F.when(F.length(digits) > 10, F.substring(digits, -10, 10))
                   .otherwise(digits))
            .when(kind.isin("CARD", "SSN"), digits)
            .when(kind == "IBAN", F.regexp_replace(m, " ", ""))
            .when(kind == "SECRET", F.regexp_replace(m, r"^\w+[-]?\w*[\"']?[ \t]*[=:][ \t]*[\"']?", ""))
            .when(kind == "EMAIL", F.lower(F.regexp_replace(m, "^[._%+-]+(?=[^@])", "")))
            .when(kind.isin("SURNAME", "IPV6"), F.lower(m)).otherwise(m))


def _pick(alphabet: str, digest: Column, at: Column) -> Column:
    place = F.pmod(F.xxhash64(digest, at), F.lit(len(alphabet))).cast("int") + 1
    return F.substr(F.lit(alphabet), place, F.lit(1))


def _same_class(c: Column, digest: Column, at: Column, hexadecimal: bool = False) -> Column:
    """A drawn character of c's class: digit, case and script stay."""
    lower, upper = ("abcdef", "ABCDEF") if hexadecimal else (LOWER, LOWER.upper())
    return (F.when(c.rlike("[0-9]"), _pick("0123456789", digest, at))
            .when(c.rlike(r"\p{IsCyrillic}"), F.when(c == F.lower(c), _pick(CYRILLIC, digest, at))
                  .otherwise(_pick(CYRILLIC.upper(), digest, at)))
            .when(c.rlike(r"\p{Ll}"), _pick(lower, digest, at))
            .when(c.rlike(r"\p{L}"), _pick(upper, digest, at)).otherwise(c))


def _each(m: Column, fn) -> Column:
    """``fn`` of every character and its place counted from the right over
    letters and digits, joined."""
    def one(i: Column) -> Column:
        right = F.length(F.regexp_replace(F.substr(m, i + 1, F.length(m)), r"[^\p{L}\p{N}]", ""))
        return _let(F.struct(F.substr(m, i, F.lit(1)).alias("c"), right.alias("r")),
                    lambda s: fn(s["c"], s["r"]))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), one), "")


def _digest(key: str, kind: Column | str, canonical: Column, attempt: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.sha2(F.concat_ws("\u0001", F.lit(key), kind, canonical, attempt.cast("string")), 256)


def _luhn(digits: Column, upto: Column) -> Column:
    """Luhn sum of a digit string without its last digit, which is doubled
    from the right."""
    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), upto), F.lit(0), add)


def _card(m: Column, digest: Column) -> Column:
    """Issuer digit and separators stay, and a valid number stays valid."""
    n = F.length(_digits(m))
    drawn = _each(m, lambda c, r: F.when(r == n - 1, c).otherwise(_same_class(c, digest, r)))

    def checked(d: Column) -> Column:
        old, new = _digits(m), _digits(d)
        last = F.substring(old, -1, 1).cast("int")
        valid = (_luhn(old, n - 1) + last) % 10 == 0
        need = F.pmod(F.lit(10) - _luhn(new, n - 1) % 10, F.lit(10))
        other = (need + 1 + F.pmod(F.xxhash64(digest), F.lit(9)).cast("int")) % 10
        check = F.when(valid, need).otherwise(other).cast("string")
        return F.concat(F.substr(d, F.lit(1), F.length(d) - 1), check)

    return _let(drawn, checked)


def _phone(m: Column, digest: Column) -> Column:
    """The country code stays; area and exchange do not begin with 0 or 1."""
    def digit(c: Column, r: Column) -> Column:
        lead = F.when(r.isin(9, 6), _pick("23456789", digest, r))
        return (F.when(~c.rlike("[0-9]") | (r >= 10), c)
                .otherwise(F.coalesce(lead, _pick("0123456789", digest, r))))
    return _each(m, digit)


def _address(digest: Column) -> Column:
    octets = [(F.pmod(F.xxhash64(digest, F.lit(k)), F.lit(254)) + 1).cast("string")
              for k in range(4)]
    return F.concat_ws(".", *octets)


def _mail(key: str, m: Column, digest: Column, attempt: Column) -> Column:
    """Local part and domain by their classes; one domain has one surrogate,
    its last label and reserved example domains stay."""
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    tail = F.regexp_extract(domain, r"(?i)((?:\.|^)example)?\.\p{L}+$", 0)
    head = F.substr(domain, F.lit(1), F.length(domain) - F.length(tail))
    own = _digest(key, "DOMAIN", F.lower(domain), F.lit(0))
    more = F.when(attempt > 7, _each(F.repeat(F.lit("0"), attempt - 7),
                                     lambda c, r: _same_class(c, digest, r + 1000))).otherwise("")
    return F.concat(_each(local, lambda c, r: _same_class(c, digest, r)), more, F.lit("@"),
                    _each(head, lambda c, r: _same_class(c, own, r)), tail)


def _surname(m: Column, digest: Column, attempt: Column) -> Column:
    """Syllables of the name's script, in its case, with a Cyrillic name's
    gendered ending; each attempt has one syllable more."""
    def joined(script: str) -> Column:
        sounds = F.array(*[F.lit(s) for s in SYLLABLES[script]])
        return F.array_join(F.transform(F.sequence(F.lit(1), attempt + 3), lambda i: F.element_at(
            sounds, F.pmod(F.xxhash64(digest, i), F.lit(len(SYLLABLES[script]))).cast("int") + 1)), "")
    ending = F.when(F.lower(m).rlike("[ая]$"), "ова").otherwise("ов")
    name = F.when(m.rlike(r"\p{IsCyrillic}"), F.concat(joined("cyrillic"), ending)).otherwise(
        joined("latin"))
    return F.when((F.upper(m) == m) & (F.length(m) > 1), F.upper(name)).otherwise(F.initcap(name))


def _surrogate(key: str, p: Column) -> Column:
    """The surrogate of a part: kind, m, canonical, attempt."""
    kind, m, attempt = p["kind"], p["m"], p["attempt"]
    first = F.create_map(*[F.lit(x) for pair in _renamed(key).items() for x in pair])
    keyword = F.regexp_extract(m, r"^\w+[-]?\w*[\"']?[ \t]*[=:][ \t]*[\"']?", 0)
    issuer = F.regexp_extract(m, KEY_PREFIX, 0)

    def drawn(digest: Column) -> Column:
        free = _each(m, lambda c, r: _same_class(c, digest, r))
        hexes = _each(m, lambda c, r: _same_class(c, digest, r, hexadecimal=True))
        value = F.substr(m, F.length(keyword) + 1, F.length(m))
        secret = F.when(value.rlike("^[0-9a-fA-F]+$"),
                        _each(value, lambda c, r: _same_class(c, digest, r, hexadecimal=True))
                        ).otherwise(_each(value, lambda c, r: _same_class(c, digest, r)))
        return (F.when(kind == "EMAIL", _mail(key, m, digest, attempt))
                .when(kind == "PHONE", _phone(m, digest))
                .when(kind == "IP", _address(digest))
                .when(kind == "CARD", _card(m, digest))
                .when(kind == "SECRET", F.concat(keyword, secret))
                .when((kind == "IPV6") | ((kind == "KEY") & m.rlike("^[0-9a-f]+$")), hexes)
                .when(kind == "KEY", F.concat(issuer, F.substr(free, F.length(issuer) + 1,
                                                               F.length(m))))
                .when(kind == "FIRST", F.element_at(first, m))
                .when(kind == "SURNAME", _surname(m, digest, attempt))
                .when(kind == "IBAN", F.concat(F.substring(m, 1, 2), F.substr(free, F.lit(3), F.length(m))))
                .when(kind == "TITLE", m).otherwise(free))

    return _let(_digest(key, kind, p["canonical"], attempt), drawn)


def _found(text: Column) -> Column:
    """The entities of a text in order, each with its parts."""
    kinds = F.transform(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)),
                        lambda m: F.struct(_kind(m).alias("kind"), m.alias("m")))
    return F.transform(kinds, lambda e: F.transform(
        _parts(e["m"], e["kind"]), lambda p: F.struct(
            p["kind"].alias("kind"), p["m"].alias("m"), _canonical(p).alias("canonical"))))


def exceptions(found: DataFrame, key: str, entities: str, label: str = "pii") -> DataFrame:
    """kind, canonical and attempt of the entities whose first draw collides.

    ``found`` has the array of each text's entities in column ``entities``.
    """
    parts = found.select(F.explode(F.array_distinct(F.flatten(entities))).alias("p"))
    # first names are renamed one to one, titles stay: neither can collide
    named = (parts.filter(~F.col("p.kind").isin("TITLE", "FIRST"))
             .groupBy(F.col("p.kind").alias("kind"), F.col("p.canonical").alias("canonical"))
             .agg(F.min("p.m").alias("m")))
    drawn = stored(named.withColumn("attempt", F.lit(0)), f"{label}-entities")
    known = drawn.select("kind", F.col("canonical").alias("c"))
    for _ in range(MAX_ATTEMPTS):
        made = drawn.withColumn("s", _surrogate(key, F.struct("kind", "m", "canonical", "attempt")))
        same = F.struct(F.col("kind").alias("kind"), F.col("s").alias("m"))
        made = stored(made.withColumn("c", _canonical(same)), f"{label}-drawn")
        # the entity of fewest attempts keeps a surrogate, then the smallest
        one = made.groupBy("kind", "c").agg(
            F.min(F.struct(-F.col("attempt"), "canonical"))["canonical"].alias("keeps"))
        real = known.withColumn("real", F.lit(True))
        judged = (made.join(one, ["kind", "c"]).join(real, ["kind", "c"], "left")
                  .withColumn("again", F.col("real").isNotNull()
                              | (F.col("keeps") != F.col("canonical"))))
        drawn = stored(judged.select("kind", "canonical", "m", "again",
                                     (F.col("attempt") + F.col("again").cast("int")).alias("attempt")),
                       f"{label}-next")
        if drawn.filter("again").isEmpty():
            return drawn.filter("attempt > 0").select("kind", "canonical", "attempt")
        drawn = drawn.drop("again")
    raise RuntimeError("an entity's format has too few surrogates left")


def replace_pii(docs: DataFrame, key: str, text: str = "text", entities: str | None = None
                ) -> DataFrame:
    """``docs`` with surrogates in column ``text``; with a name ``entities``
    also the array of found kinds, one for each entity."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    e, h, a = fresh(docs, "entities__"), fresh(docs, "hash__"), fresh(docs, "attempts__")
    found = docs.withColumn(e, _found(F.col(text)))
    bad = exceptions(found.select(e), key, e)
    if bad.isEmpty():
        wide = found.withColumn(a, F.lit(None).cast("map<string,int>"))
    else:
        own = found.filter(F.size(e) > 0).select(F.xxhash64(text).alias("h"), e)
        pairs = own.select("h", F.explode(F.flatten(e)).alias("p")).select(
            "h", F.col("p.kind").alias("kind"), F.col("p.canonical").alias("canonical")).distinct()
        entry = F.struct(F.concat_ws("\u0001", "kind", "canonical"), "attempt")
        fixes = stored(pairs.join(bad, ["kind", "canonical"]).groupBy(F.col("h").alias(h)).agg(
            F.map_from_entries(F.collect_set(entry)).alias(a)), "pii-fixes")
        wide = found.withColumn(h, F.xxhash64(text)).join(fixes, h, "left")

    def replaced(parts: Column) -> Column:
        def one(p: Column) -> Column:
            name = F.concat_ws("\u0001", p["kind"], p["canonical"])
            attempt = F.coalesce(F.element_at(F.col(a), name), F.lit(0))
            return _let(F.struct(p["kind"].alias("kind"), p["m"].alias("m"),
                                 p["canonical"].alias("canonical"), attempt.alias("attempt")),
                        lambda q: _surrogate(key, q))
        return F.array_join(F.transform(parts, one), " ")

    gaps = F.split(F.col(text), ENTITY, -1)
    new = F.concat(F.transform(F.col(e), replaced), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(gaps, new, lambda g, s: F.concat(g, s)), "")
    masked = F.when(F.size(e) > 0, joined).otherwise(F.col(text)).alias(text)
    out = [masked if c == text else x for c, x in zip(docs.columns, columns)]
    if entities:
        name = F.transform(F.col(e), lambda p: F.when(F.size(p) > 1, "NAME").otherwise(
            F.element_at(p, 1)["kind"]))
        out.append(F.coalesce(name, F.array().cast("array<string>")).alias(entities))
    return wide.select(*out)


def secret(value: str) -> str:
    """A key of fixed length from a secret of the caller's."""
    return hashlib.sha256(value.encode()).hexdigest()
