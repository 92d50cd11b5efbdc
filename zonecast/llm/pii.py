"""Personal data replaced by keyed surrogates of the same type and format.

Detected: e-mail addresses, telephone numbers, IPv4 addresses, payment card
numbers, social-security numbers, secrets behind ``token =`` and the like,
and names behind a title (a capital of any script, then letters with inner
capitals, apostrophes and hyphens; titles as listed or in capitals).  An
entity is a kind and a canonical value, so mentions that differ in case,
punctuation, the script of digits or the composition of accents corefer.  Its surrogate depends
only on key, kind, value and attempt:

* strings are permuted within their alphabet (digits stay digits, Latin,
  accented, Greek or Cyrillic letters and those of any other script stay
  such, case and punctuation are the mention's) by a keyed Feistel network with cycle walking, a bijection, so
  different values of one format get different surrogates by construction;
* cards keep their first digit and whether the Luhn check holds; IPv4
  addresses stay valid; domains keep their last label;
* given names come first from a list for gender and script, further ones and
  surnames are built from syllables of the script, more with every attempt.
  A given name is one entity a script whatever title it stands behind; its
  gender only directs the draw (titles of both genders, or of none, draw a
  neutral name).

Collision checks run over all entities of the corpus: a surrogate that is
some real entity's value, or another entity's surrogate, is drawn again with
the next attempt until none is left, without exception.  Names lengthen with
the attempt; e-mail addresses, secrets and telephone numbers do after every
``SAME`` draws, so that a format whose few values are all in use isn't the
end.  (IPv4 addresses, cards and social-security numbers can't be longer;
should MAX_ATTEMPTS draws of one all be taken, the run fails.)  Entities are counted and joined as a
table; only the few that needed another attempt are joined back to the
texts that mention them (the planner broadcasts them if they are small).

Defined results: a null text stays null, with no entities; ids are carried,
repeated rows are rewritten alike; text outside entities stays byte for
byte.  Overlapping detections are resolved by the order of ``KINDS``.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.llm.common import small_batches, text_frame, written

KEY = b"zonecast-surrogates"  # a deployment passes its own secret
MAX_ATTEMPTS = 64
SAME = 16           # draws in a value's own format before it may lengthen
ENTITIES = "kind string, value string"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_UPPER = "".join(re.findall(r"\w", "".join(c for c in map(chr, range(0x20000)) if c.isupper() or c.istitle())))
_MARKS = "".join(c for c in map(chr, range(0x300, 0x20000)) if unicodedata.category(c) in ("Mn", "Mc"))
_LETTERS = rf"(?:[^\W\d_]|[{_MARKS}])+"
_MORE = rf"['’-](?![sS](?!\w)){_LETTERS}"  # not a genitive
_NAME = rf"[{_UPPER}](?:{_LETTERS}(?:{_MORE})*|(?:{_MORE})+)"
_TITLES = {"m": ("Mr", "Herr", "Monsieur", "Señor", "господин", "г-н"),
           "f": ("Mrs", "Ms", "Frau", "Madame", "Mme", "Señora", "госпожа", "г-жа"), "n": ("Dr", "Prof")}
_TITLE = {t: g for g, ts in _TITLES.items() for x in ts for t in (x, x.upper())}
_AHEAD = {"MS": rf"(?=\.? [{_UPPER}]['’-]?[{_UPPER}])"}  # MS SMITH, not MS Office
# Kind, pattern (group 1 is the entity), and what any text with a match holds.
KINDS = (
    ("secret", re.compile(r"(?i)(?<!\w)(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\s*[:=]\s*[\"']?((?=[+/_-]{0,255}[A-Za-z0-9])[A-Za-z0-9+/_-]{16,256})"), re.compile("[=:]")),
    ("email", re.compile(rf"(?<![\w.%+{_MARKS}-])(\w[\w.%+{_MARKS}-]{{0,63}}@[A-Za-z0-9-]{{1,63}}(?:\.[A-Za-z0-9-]{{1,63}}){{0,8}}\.[A-Za-z]{{2,24}})(?![\w@])"), re.compile("@")),
    ("ip", re.compile(rf"(?<![\w.])((?:{_OCTET}\.){{3}}{_OCTET})(?!\w|\.\d)"), re.compile(r"\d\.\d")),
    ("card", re.compile(r"(?<![\w+.-])(\d(?:[ -]?\d){12,18})(?!\w|[.-]\d)"), re.compile(r"\d[ -]?\d")),
    ("ssn", re.compile(r"(?<![\w-])(\d{3}-\d{2}-\d{4})(?![\w-])"), re.compile(r"\d-\d")),
    ("phone", re.compile(r"(?<![\w+])((?:\+?\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}|\+\d{1,3}(?:[ .-]\d{2,4}){2,5})(?!\w)"), re.compile(r"\d{2}")),
    ("name", re.compile(rf"(?<!\w)(?:{'|'.join(re.escape(t) + _AHEAD.get(t, '') for t in _TITLE)})\.? ({_NAME}(?: {_NAME})?)(?!\w)"), None),
)
_DIGIT = re.compile(r"\d")

ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ",
             "āăąćĉċčďđēĕėęěĝğġģĥħĩīĭįĵķĺļľłńņňōŏőŕŗřśŝşšţťŧũūŭůűųŵŷźżž",
             "αβγδεζηθικλμνξοπρστυφχψω", "абвгдеёжзийклмнопрстуфхцчшщъыьэюя")
HEX = "0123456789abcdef"
_ALPHABET = {c: a for a in ALPHABETS for c in a}
GIVEN = {
    ("m", "latin"): "Adam Albert Bruno Carl Daniel David Emil Felix George Henry Hugo Jacob Leo Louis Martin Oscar Paul Peter Samuel Thomas".split(),
    ("f", "latin"): "Alice Anna Clara Diana Elena Emma Eva Helen Irene Julia Laura Lucy Maria Martha Nora Olivia Rosa Sarah Sofia Vera".split(),
    ("m", "cyrillic"): "Алексей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Олег Павел".split(),
    ("f", "cyrillic"): "Алла Вера Галина Дарья Елена Жанна Ирина Лидия Мария Нина Ольга Софья".split(),
}
GIVEN["n", "latin"] = "Alex Chris Dana Jamie Jordan Kim Lee Morgan Robin Sam Taylor Toni".split()
GIVEN["n", "cyrillic"] = "Женя Саша Валя Слава Шура Миша Никита Паша".split()
SYLLABLES = {"latin": "bar bel cor dan del far gan hal kel lan mar nor pel ran sel tan ver wal".split(),
             "cyrillic": "бор вол гор дан кар лев мар нов пет ром сав тар".split(),
             "greek": "βαρ γαλ δαν καρ λαν μαρ νορ παν ροδ σαρ ταν φιλ".split()}
ENDINGS = {("m", "latin"): "us", ("f", "latin"): "a", ("n", "latin"): "y",
           ("m", "cyrillic"): "", ("f", "cyrillic"): "а", ("n", "cyrillic"): "и",
           ("m", "greek"): "ος", ("f", "greek"): "α", ("n", "greek"): "ι"}


@lru_cache(1)
def _others() -> dict[str, str]:
    """The alphabets of all letters and digits not in ALPHABETS: one a
    script (the first word of the characters' names) and plane."""
    groups: dict[tuple, list[str]] = {}
    for c in map(chr, range(128, sys.maxunicode + 1)):
        if c.isalnum() and c not in _ALPHABET and (c.lower() == c or len(c.lower()) > 1):
            name = re.split("[ -]", unicodedata.name(c, ""), maxsplit=1)[0]
            groups.setdefault((name, c.isdecimal(), ord(c) >> 16), []).append(c)
    rest = [c for g in groups.values() if len(g) < 10 for c in g]
    alphabets = ["".join(g) for g in (*(g for g in groups.values() if len(g) >= 10), rest)]
    return {c: a for a in alphabets for c in a}


class Surrogates:
    """Keyed surrogate values; the same key always gives the same ones."""

    def __init__(self, key: bytes = KEY):
        self.key = key
        self.of = lru_cache(200_000)(self._of)

    def _hash(self, *parts) -> int:
        raw = "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass")
        return int.from_bytes(hashlib.blake2b(raw, key=self.key[:64], digest_size=16).digest(), "big")

    def permute(self, x: int, size: int, tweak: str) -> int:
        """A keyed permutation of 0..size-1 (Feistel, cycle walking)."""
        if size < 2:
            return x
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        mask = (1 << half) - 1
        while True:
            left, right = x >> half, x & mask
            for k in range(8):
                left, right = right, left ^ (self._hash(tweak, half, k, right) & mask)
            x = left << half | right
            if x < size:
                return x

    def letters(self, value: str, tweak: str, alphabet: dict[str, str] = _ALPHABET) -> str:
        """Permute all letters and digits, each within its alphabet."""
        alphabets = [alphabet.get(c) or (_others().get(c) if c > "\x7f" and c.isalnum() else None) for c in value]
        if not any(alphabets):
            return value
        shape = "".join("x" if a is None else f"{len(a)}." for a in alphabets)
        size, x = 1, 0
        for c, a in zip(value, alphabets):
            if a:
                x, size = x * len(a) + a.index(c), size * len(a)
        x = self.permute(x, size, f"{tweak}:{shape}")
        out = []
        for c, a in zip(reversed(value), reversed(alphabets)):
            if a:
                x, k = divmod(x, len(a))
                c = a[k]
            out.append(c)
        return "".join(reversed(out))

    def syllables(self, value: str, tweak: str, script: str, count: int) -> str:
        h, out = self._hash(tweak, value), ""
        parts = SYLLABLES[script]
        for _ in range(count):
            h, k = divmod(h, len(parts))
            out += parts[k]
        return out

    def _of(self, kind: str, value: str, attempt: int) -> str:
        tweak, more = f"{kind}:{attempt}", attempt // SAME
        if kind == "email":
            local, _, rest = value.partition("@")
            domain, _, last = rest.rpartition(".")
            return self.letters(f"{local}{'a' * more}@{domain}", tweak) + "." + last
        if kind == "ip":
            x = 0
            for o in value.split("."):
                x = x << 8 | int(o)
            x = self.permute(x, 1 << 32, tweak)
            return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))
        if kind == "card":
            off = luhn(value)  # 0 for a valid number; kept
            body = value[0] + self.letters(value[1:-1], tweak)
            return next(body + d for d in "0123456789" if luhn(body + d) == off)
        if kind.startswith("given"):
            _, gender, script = kind.split(":")
            if attempt == 0 and (gender, script) in GIVEN:
                names = GIVEN[gender, script]
                return names[self._hash(tweak, value) % len(names)].lower()
            return self.syllables(value, tweak, script, 1 + attempt) + ENDINGS[gender, script]
        if kind.startswith("surname"):
            return self.syllables(value, tweak, kind.split(":")[1], 3 + attempt // 4)
        if kind == "secret":
            hexadecimal = re.fullmatch(f"[{HEX}-]+", value)
            return self.letters(value + "a" * more, tweak, dict.fromkeys(HEX, HEX) if hexadecimal else _ALPHABET)
        if kind == "phone":
            value += "0" * more
            out = self.letters(value, tweak)
            while len(out) == 11 and out[0] == "1" != value[0]:  # would read as ten digits behind +1
                out = self.letters(out, tweak)
            return out
        return self.letters(value, tweak)


def luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def script(word: str) -> str:
    if "Ͱ" <= word[0] <= "Ͽ" or "ἀ" <= word[0] <= "\u1fff":
        return "greek"
    return "cyrillic" if "Ѐ" <= word[0] <= "ԯ" else "latin"


def spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities of a text, in order."""
    found, digit = [], bool(_DIGIT.search(text))
    for kind, pattern, needs in KINDS:
        if kind in ("ip", "card", "ssn", "phone") and not digit or needs and not needs.search(text):
            continue
        for m in pattern.finditer(text):
            a, b = m.span(1)
            if all(b <= s or a >= e for s, e, _, _ in found):
                found.append((a, b, kind, text[m.start():a]))
    out = []
    for a, b, kind, before in sorted(found):
        if kind != "name":
            out.append((a, b, kind))
            continue
        gender, words = _TITLE[before.split(".")[0].strip()], text[a:b].split(" ")
        if len(words) == 2:
            out.append((a, a + len(words[0]), f"given:{gender}:{script(words[0])}"))
        out.append((b - len(words[-1]), b, f"surname:{script(words[-1])}"))
    return out


def entity(kind: str) -> str:
    """The kind that all mentions of an entity share: no gender."""
    return re.sub("^given:[mfn]:", "given:", kind)


def canonical(kind: str, mention: str) -> str:
    """The value that all mentions of an entity share."""
    if kind in ("card", "ssn", "phone"):
        digits = "".join(str(int(c)) for c in mention if c.isdecimal())
        return digits[1:] if kind == "phone" and len(digits) == 11 and digits[0] == "1" else digits
    if kind == "ip":
        return ".".join(str(int(o)) for o in mention.split("."))
    if kind.startswith(("given", "surname")):
        return unicodedata.normalize("NFC", mention).lower().replace("’", "'")
    low = mention.lower()
    return low if len(low) == len(mention) else "".join(c.lower() if len(c.lower()) == 1 else c for c in mention)


def render(kind: str, mention: str, surrogate: str) -> str:
    """A surrogate in the mention's own format."""
    if kind in ("card", "ssn", "phone"):
        skip = sum(c.isdigit() for c in mention) - len(surrogate)  # a country code
        digits, out = iter(surrogate), []
        for c in mention:
            if c.isdigit() and skip > 0:
                skip -= 1
            elif c.isdigit():
                c = chr(ord(c) - int(c) + int(next(digits)))  # a digit of the same script
            out.append(c)
        return "".join((*out, *digits))
    if kind.startswith(("given", "surname")):
        return surrogate.title() if not mention.isupper() else surrogate.upper()
    if len(surrogate) != len(mention):
        return surrogate
    return "".join(s.upper() if m.isupper() and len(s.upper()) == 1 else s for s, m in zip(surrogate, mention))


def replace(text: str, surrogates: Surrogates,
            attempts: dict[tuple[str, str], tuple[str, int]]) -> tuple[str, list[str]]:
    """The text with surrogates, and the kinds replaced.  ``attempts`` holds
    (kind, attempt) of the entities not drawn by the mention's own kind in
    the first attempt."""
    out, last, kinds = [], 0, []
    for a, b, kind in spans(text):
        value = canonical(kind, text[a:b])
        drawn, attempt = attempts.get((entity(kind), value), (kind, 0))
        new = surrogates.of(drawn, value, attempt)
        out += text[last:a], render(kind, text[a:b], new)
        last = b
        kinds.append(kind.split(":")[0])
    return "".join((*out, text[last:])) if kinds else text, kinds


def _mentions(batches, with_text: bool):
    for batch in batches:
        rows = set()
        for k, t in enumerate(batch.column("text").to_pylist()):
            where = (batch.column("h")[k].as_py(),) if with_text and t else ()
            rows.update((*where, entity(kind) if with_text else kind, canonical(kind, t[a:b]))
                        for a, b, kind in (spans(t) if t else ()))
        columns = list(zip(*sorted(rows))) if rows else [[]] * (2 + with_text)
        types = [pa.int64()] * with_text + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                         ["h", "entity", "value"] if with_text else ["kind", "value"])


def assign(entities: DataFrame, key: bytes = KEY) -> DataFrame:
    """kind, value, attempt, surrogate, mixed: no surrogate is a real value
    of its kind, nor any other entity's surrogate.  A given name's kind has
    the gender drawn; ``mixed`` tells that its mentions have several."""
    def draw(batches):
        s = Surrogates(key)
        for b in batches:
            new = [s.of(*x) for x in zip(*(b.column(c).to_pylist() for c in ("kind", "value", "attempt")))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(new, pa.string())], [*b.schema.names, "surrogate"])

    gender = F.regexp_extract("kind", "^given:([mfn]):", 1)
    entities = (entities.withColumn("gender", gender).withColumn("entity", F.regexp_replace("kind", "^given:[mfn]:", "given:"))
                .groupBy("entity", "value").agg(F.collect_set("gender").alias("genders")))
    known = F.array_except("genders", F.array(F.lit("n")))
    entities = written(entities.select(
        "entity", "value", (F.size("genders") > 1).alias("mixed"),
        F.when(F.array_contains("genders", ""), F.col("entity"))
        .otherwise(F.concat(F.lit("given:"), F.when(F.size(known) == 1, known[0]).otherwise("n"),
                            F.substring("entity", 6, 99))).alias("kind")), "entities")
    columns = ["entity", "value", "mixed", "kind"]
    schema = "entity string, value string, mixed boolean, kind string, attempt int, surrogate string"
    pending, done = entities.withColumn("attempt", F.lit(0)), None
    for _ in range(MAX_ATTEMPTS):
        drawn = written(pending.mapInArrow(draw, schema), "surrogates")
        taken = entities.select("entity", F.col("value").alias("surrogate"))
        if done is not None:
            taken = taken.unionByName(done.select("entity", "surrogate"))
        clash = drawn.join(taken.distinct().withColumn("taken", F.lit(True)), ["entity", "surrogate"], "left")
        order = Window.partitionBy("entity", "surrogate").orderBy("value")
        clash = written(clash.withColumn("again", F.col("taken").isNotNull() | (F.row_number().over(order) > 1)), "checked")
        good = clash.filter("NOT again").select(*columns, "attempt", "surrogate")
        done = good if done is None else done.unionByName(good)
        pending = clash.filter("again").select(*columns, (F.col("attempt") + 1).alias("attempt"))
        if pending.isEmpty():
            return done.select("kind", "value", "attempt", "surrogate", "mixed")
    raise RuntimeError("no free surrogate after MAX_ATTEMPTS draws")


def _with_attempts(docs: DataFrame, text: str, key: bytes) -> DataFrame:
    """``docs`` and a column of the entities whose first draw collided, or
    is of another gender than some mention's title."""
    src = docs.select(F.col(text).cast("string").alias("text"))
    entities = written(src.mapInArrow(lambda b: _mentions(b, False), ENTITIES).distinct(), "entities")
    redrawn = assign(entities, key).filter("attempt > 0 OR mixed").select(
        F.regexp_replace("kind", "^given:[mfn]:", "given:").alias("entity"), "value", "kind", "attempt")
    redrawn = written(redrawn, "redrawn")
    if redrawn.isEmpty():
        return docs.withColumn("__redrawn", F.lit(None).cast("array<struct<entity:string,value:string,kind:string,attempt:int>>"))
    hashed = src.withColumn("h", F.xxhash64("text"))
    by_text = (hashed.mapInArrow(lambda b: _mentions(b, True), "h long, entity string, value string").distinct()
               .join(redrawn, ["entity", "value"]).groupBy(F.col("h").alias("__h"))
               .agg(F.collect_list(F.struct("entity", "value", "kind", "attempt")).alias("__redrawn")))
    return docs.join(written(by_text, "texts"), F.xxhash64(F.col(text).cast("string")) == F.col("__h"), "left").drop("__h")


def _attempts(cell) -> dict:
    return {(x["entity"], x["value"]): (x["kind"], x["attempt"]) for x in cell or ()}


def anonymise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", key: bytes = KEY) -> DataFrame:
    """doc_id, n_entities, kinds (sorted, distinct), text of every row."""
    small_batches(docs.sparkSession)

    def run(batches):
        s = Surrogates(key)
        for b in batches:
            new, count, kinds = [], [], []
            for t, r in zip(b.column("text").to_pylist(), b.column("__redrawn").to_pylist()):
                x, k = replace(t, s, _attempts(r)) if t else (t, [])
                new.append(x), count.append(len(k)), kinds.append(",".join(sorted(set(k))))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(count, pa.int64()), pa.array(kinds, pa.string()), pa.array(new, pa.string())],
                ["doc_id", "n_entities", "kinds", "text"])

    src = text_frame(docs, doc_id, text)
    return _with_attempts(src, "text", key).mapInArrow(run, "doc_id long, n_entities long, kinds string, text string")


def anonymise_column(docs: DataFrame, text: str = "text", key: bytes = KEY) -> DataFrame:
    """The rows of ``docs``, all columns, with the text rewritten."""
    small_batches(docs.sparkSession)
    packed = docs.select(F.struct("*").alias("doc"), F.col(text).cast("string").alias("text"))

    def run(batches):
        s = Surrogates(key)
        for b in batches:
            new = [replace(t, s, _attempts(r))[0] if t else t
                   for t, r in zip(b.column("text").to_pylist(), b.column("__redrawn").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(new, pa.string())], ["doc", "text"])

    rows = _with_attempts(packed, "text", key)
    done = rows.mapInArrow(run, T.StructType([rows.schema["doc"], T.StructField("text", T.StringType())]))
    return done.select(*(F.col("text").alias(c) if c == text else F.col("doc")[c].alias(c) for c in docs.columns))
