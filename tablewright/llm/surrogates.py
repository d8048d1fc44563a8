"""Personal data replaced by keyed surrogates of the same kind, gender, script and format.

An entity's surrogate is drawn from HMAC-SHA-256 of (key, kind, canonical value,
attempt), so every mention of it in any document gets the same one. Distinctness
is checked over all entities of the corpus: where two would share a surrogate, or
one equals a value that occurs, the entity goes on to its next attempt. Only
entities beyond attempt 0 travel back to the documents that hold them.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablewright.llm.common import documents, id_and_text, slices, text_key
from tablewright.session import map_arrow, materialize

KEY = b"surrogates"  # of the query; an owner passes a secret one

#: Honorifics that tell a gender, or none.
HONORIFICS = {"Mr.": "m", "Mrs.": "f", "Ms.": "f", "Dr.": "", "Herr": "m", "Frau": "f", "Sr.": "m", "Sra.": "f", "Mme": "f", "г-н": "m", "г-жа": "f"}
#: Given names to draw from, by script and gender.
GIVEN = {
    ("LATIN", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Jonas", "Leon", "Martin", "Oscar", "Paul", "Simon", "Tom", "Victor", "Xavier"],
    ("LATIN", "f"): ["Alice", "Berta", "Clara", "Diana", "Emma", "Flora", "Helen", "Julia", "Laura", "Maria", "Nora", "Olivia", "Paula", "Rosa", "Sara", "Vera"],
    ("LATIN", ""): ["Alex", "Charlie", "Dana", "Jamie", "Kim", "Noel", "Robin", "Sascha"],
    ("CYRILLIC", "m"): ["Антон", "Борис", "Денис", "Игорь", "Максим", "Павел", "Роман", "Юрий"],
    ("CYRILLIC", "f"): ["Алина", "Вера", "Дарья", "Ирина", "Мария", "Нина", "Ольга", "Юлия"],
    ("CYRILLIC", ""): ["Женя", "Саша", "Валя", "Слава"],
}
SYLLABLES = {"LATIN": ("bdfghklmnprstv", "aeiou"), "CYRILLIC": ("бвгдзклмнпрст", "аеиоу"), "GREEK": ("βγδκλμνπρστ", "αεηιο")}
DIGITS, LOW, UP, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdef"

WIDER = 4  # attempts in the form of the value; later ones widen it more and more

# every alternative of ENTITY holds one of these: an at sign, a digit, a secret's word and sign, an honorific; or quoted or access
# values, which may go without digits
MAY_HOLD = re.compile(r"[\d@=]|(?i:password|passwd|pwd|secret|token|api_?key)[ ]?:|A[KS]IA[A-Z]{16}|sk-[A-Za-z]{20}|ghp_[A-Za-z]{36}|[\"'][a-f]{32}|" + "|".join(map(re.escape, HONORIFICS)))
_NAME = r"[^\W\d_][^\W\d_'’-]*(?:[-’'][^\W\d_]+)?"
ENTITY = re.compile(
    r"(?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8})"
    r"|(?P<access>(?<!\w)(?:A[KS]IA[A-Z0-9]{16}|ghp_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64})(?!\w))"
    r"|(?i:password|passwd|pwd|secret|token|api_?key)[ ]?[=:][ ]?[\"']?(?P<secret>[^\s\"',;]{5,127}[^\s\"',;.!?)])"
    r"|[\"'](?P<quoted>[0-9a-f]{32,128})[\"']"
    r"|(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d))"
    r"|(?P<card>(?<![\w+-])\d(?:[ -]?\d){12,18}(?!\w))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\)[ ]?\d{3}[ .-]\d{4}|\d{3}-\d{3}-\d{4})(?!\w))"
    r"|(?:(?<!\w)(?P<title>" + "|".join(map(re.escape, HONORIFICS)) + r")[ ](?P<one>" + _NAME + r")(?:[ ](?P<two>" + _NAME + r"))?)"
)
KINDS = ("email", "access", "secret", "quoted", "ip", "card", "ssn", "phone")


def luhn(digits: str) -> int:
    """Check sum of a card number, 0 if it holds."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10


def canonical(kind: str, value: str) -> str:
    if kind == "email":
        return value.lower()
    if kind in ("card", "phone", "ssn"):
        return re.sub(r"[^0-9+]", "", "".join(str(unicodedata.decimal(c, c)) for c in value))
    if kind.startswith(("given", "surname")):
        return value.casefold()
    return value


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every entity of ``text``, in order and apart."""
    if not MAY_HOLD.search(text):
        return []
    out = []
    for m in ENTITY.finditer(text):
        title = m.group("title")
        if title:
            sex = HONORIFICS[title]
            parts = [g for g in ("one", "two") if m.group(g) and m.group(g)[0].isupper()]
            if parts == ["one", "two"]:
                out += [(*m.span("one"), f"given-{sex}"), (*m.span("two"), "surname")]
            elif parts[:1] == ["one"]:
                out.append((*m.span("one"), "surname"))
            continue
        kind = next(k for k in KINDS if m.group(k) is not None)
        value = m.group(kind)
        if kind == "ip" and any(int(x) > 255 for x in value.split(".")):
            continue
        if kind == "card" and luhn(re.sub(r"\D", "", value)):
            continue
        out.append((*m.span(kind), kind))
    return out


class _Stream:
    """Numbers from a keyed hash, as many as are asked for."""

    def __init__(self, key: bytes, *parts: str):
        self.key, self.label, self.n, self.held = key, "\x1f".join(parts), 0, b""

    def below(self, n: int) -> int:
        if len(self.held) < 4:
            self.held += hmac.new(self.key, f"{self.label}\x1f{self.n}".encode(), hashlib.sha256).digest()
            self.n += 1
        out, self.held = int.from_bytes(self.held[:4], "big"), self.held[4:]
        return out * n >> 32

    def pick(self, some):
        return some[self.below(len(some))]


def _script(c: str) -> str:
    return next((x for x in SYLLABLES if unicodedata.name(c, "").startswith(x)), "LATIN")


def _same_shape(value: str, s: _Stream, more: int = 0) -> str:
    """Digits for digits, letters for letters of their script and case; hexadecimal values stay hexadecimal.

    ``more``: characters beyond the form; with any, symbols become letters too.
    """
    low = HEX if re.fullmatch(r"[0-9a-f]+", value) else LOW

    def other(c: str) -> str:
        if c.isascii() and (c in DIGITS or c in LOW or c in UP):
            return s.pick(DIGITS) if c in DIGITS else s.pick(low) if c in LOW else s.pick(UP)
        if c.isdecimal():
            return s.pick(DIGITS)
        if c.isalpha():
            new = s.pick("".join(SYLLABLES[_script(c)]))
            return new.upper() if c.isupper() else new
        return s.pick(low) if more else c

    return "".join(map(other, value)) + "".join(s.pick(low) for _ in range(more))


def _spread(value: str, digits: str) -> str:
    """``digits`` in the places of the digits of ``value``, those of a wider form after them."""
    rest = iter(digits)
    return "".join(next(rest) if c.isdecimal() else c for c in value) + "".join(rest)


def surrogate(key: bytes, kind: str, canon: str, attempt: int) -> str:
    """The canonical surrogate; ``dressed`` gives it the form of a mention."""
    s = _Stream(key, kind, canon, str(attempt))
    more = max(0, attempt - WIDER + 1)
    if kind == "email":
        local, _, domain = canon.partition("@")
        labels = domain.split(".")
        # the second level is the one reserved for examples
        return f"{_same_shape(local, s)}{''.join(s.pick(LOW) for _ in range(more))}@" + ".".join([*(_same_shape(x, s) for x in labels[:-2]), "example", labels[-1]])
    if kind == "ip":  # private addresses; the reserved block once those run short
        return ".".join(str(x) for x in ([10] if attempt < 4 else [240 + s.below(16)] if attempt < 40 else [s.below(256)]) + [s.below(256) for _ in range(3)])
    if kind == "card":
        body = canon[0] + "".join(s.pick(DIGITS) for _ in range(len(canon) - 2 + more))
        return body + str((10 - luhn(body + "0")) % 10)
    if kind == "phone":
        # the country and an exchange of fictitious numbers stay
        head = canon[:-10] if len(canon) > 10 else "+" * canon.startswith("+")
        body = canon[len(head) :]
        fixed = 3 if body[3:6] == "555" and attempt < 4 else -1
        return head + "".join(c if fixed <= i < fixed + 3 and fixed > 0 else s.pick(DIGITS) for i, c in enumerate(body)) + "".join(s.pick(DIGITS) for _ in range(more))
    if kind == "access":
        head = re.match(r"A[KS]IA|ghp_|sk-", canon)[0]
        return head + _same_shape(canon[len(head) :], s, more)
    if kind.startswith(("given", "surname")):
        script = _script(canon[0])
        names = GIVEN.get((script, kind.partition("-")[2]))
        if kind != "surname" and names and attempt == 0:
            return s.pick(names)
        hard, soft = SYLLABLES[script]
        return "".join(s.pick(hard) + s.pick(soft) for _ in range(3 + attempt // 2)).capitalize() + s.pick(hard)
    if kind == "ssn":
        return _same_shape(canon, s) + "".join(s.pick(DIGITS) for _ in range(more))
    return _same_shape(canon, s, more)


def dressed(kind: str, mention: str, new: str) -> str:
    """The surrogate in the form of the mention: its separators, or its case."""
    if kind in ("card", "phone", "ssn"):
        return _spread(mention, re.sub(r"\D", "", new))
    if kind.startswith(("given", "surname")) or kind == "email":
        return new.upper() if mention.isupper() else new
    return new


def replaced(text: str, key: bytes, attempts: dict[tuple[str, str], tuple[str, int]]) -> tuple[str, int]:
    """(text with every entity replaced, number of mentions); ``attempts``: the settled kind and the attempt of entities that have others than their own and 0."""
    found = find(text)
    if not found:
        return text, 0
    out, at = [], 0
    for a, b, kind in found:
        canon = canonical(kind, text[a:b])
        settled, attempt = attempts.get((kind, canon), (kind, 0))
        new = surrogate(key, settled, canon, attempt)
        out += [text[at:a], dressed(kind, text[a:b], new)]
        at = b
    return "".join([*out, text[at:]]), len(found)


def entities(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, entities) of the documents that hold any; each entity once a document."""

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("canon", pa.string())]))
        for batch in batches:
            for run in slices(batch, "text"):
                texts = run.column("text").to_pylist()
                found = [sorted({(k, canonical(k, t[a:b])) for a, b, k in find(t)}) for t in texts]
                at = [i for i, f in enumerate(found) if f]
                yield pa.RecordBatch.from_arrays(
                    [run.column("doc_id").take(pa.array(at, pa.int64())), run.column("text_key").take(pa.array(at, pa.int64())),
                     pa.array([[{"kind": k, "canon": c} for k, c in found[i]] for i in at], kind)], ["doc_id", "text_key", "entities"])

    return map_arrow(docs, detect, "doc_id long, text_key long, entities array<struct<kind: string, canon: string>>")


def later_attempts(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, canon, settled, attempt) of the entities whose first surrogates clash, or whose kind is settled otherwise.

    A given name has one gender over all its mentions, none where they disagree,
    and one surrogate; given names are told apart from each other. Of entities with one
    surrogate the first by hash keeps it. The rounds end when none clash; a form
    whose values run short gets wider with each attempt.
    """

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [canonical(k, surrogate(key, k, c, n)) for k, c, n in zip(*(batch.column(x).to_pylist() for x in ("kind", "canon", "attempt")))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], [*batch.schema.names, "new"])

    schema = "kind string, canon string, attempt int, new string"
    seen = materialize(found.select(F.explode("entities").alias("e")).select("e.*").distinct(), "seen")
    # mentions with a neutral honorific say nothing about the gender
    sexes = F.collect_set(F.when(F.col("kind") != "given-", F.col("kind")))
    given = seen.where(F.col("kind").startswith("given")).groupBy("canon").agg(sexes.alias("all"))
    given = given.select("canon", F.when(F.size("all") == 1, F.col("all")[0]).otherwise("given-").alias("kind"))
    real = materialize(seen.where(~F.col("kind").startswith("given")).select("kind", "canon").unionByName(given), "entities")
    state = materialize(map_arrow(real.withColumn("attempt", F.lit(0)), draw, schema), "drawn")

    def among(kind: str) -> Column:
        """Given names of all genders are told apart from each other."""
        return F.when(F.col(kind).startswith("given"), "given").otherwise(F.col(kind))

    taken = real.select(among("kind").alias("real_kind"), F.col("canon").alias("real"))
    while True:
        # who keeps a surrogate is settled before the shuffle
        drawn = state.withColumn("among", among("kind"))
        first = drawn.groupBy("among", "new").agg(F.min(F.struct("attempt", F.xxhash64("canon").alias("h"), "canon")).alias("first"))
        judged = drawn.join(first, ["among", "new"]).join(taken, (F.col("among") == F.col("real_kind")) & (F.col("new") == F.col("real")), "left")
        judged = materialize(judged.select("kind", "canon", "attempt", "new", ((F.col("first.canon") != F.col("canon")) | F.col("real").isNotNull()).alias("clash")), "judged")
        again = judged.where("clash")
        if again.isEmpty():
            break
        moved = map_arrow(again.select("kind", "canon", (F.col("attempt") + 1).alias("attempt")), draw, schema)
        state = materialize(judged.where("not clash").select("kind", "canon", "attempt", "new").unionByName(moved), "drawn")
    others = judged.where((F.col("attempt") > 0) & ~F.col("kind").startswith("given")).select("kind", "canon", F.col("kind").alias("settled"), "attempt")
    names = judged.where(F.col("kind").startswith("given")).select("canon", F.col("kind").alias("settled"), "attempt")
    mentions = seen.where(F.col("kind").startswith("given")).join(names, "canon").where("attempt > 0 or kind <> settled")
    return others.unionByName(mentions.select("kind", "canon", "settled", "attempt"))


def with_surrogates(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_entities (mentions replaced), text.

    A text without entities, an empty or a null one (as the empty one) comes back
    as it is; repeated rows come out alike; an empty table gives no rows. Texts
    are read twice and move only if later attempts are too many for a broadcast
    that Spark's size check allows.
    """
    own = id_and_text(docs, id_col, text_col).withColumn("text_key", text_key(F.col("text")))
    found = materialize(entities(own), "found")
    later = later_attempts(found, key)
    held = found.select("doc_id", "text_key", F.explode("entities").alias("e")).select("doc_id", "text_key", "e.*").distinct()
    by_doc = held.join(later, ["kind", "canon"]).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("kind", "canon", "settled", "attempt")).alias("attempts"))
    by_doc = materialize(by_doc, "attempts").select(F.col("doc_id").alias("i"), F.col("text_key").alias("k"), "attempts")
    joined = own.join(by_doc, own["doc_id"].eqNullSafe(by_doc["i"]) & (own["text_key"] == by_doc["k"]), "left").select("doc_id", "text", "attempts")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in slices(batch, "text"):
                got = [replaced(t, key, {(a["kind"], a["canon"]): (a["settled"], a["attempt"]) for a in more or ()})
                       for t, more in zip(run.column("text").to_pylist(), run.column("attempts").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [run.column("doc_id"), pa.array([n for _, n in got], pa.int64()), pa.array([t for t, _ in got], pa.string())], ["doc_id", "n_entities", "text"])

    return map_arrow(joined, apply, "doc_id long, n_entities long, text string")


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_surrogates(documents(spark, sf_dir), KEY)


QUERIES = {"op5_surrogates": op5_surrogates}
