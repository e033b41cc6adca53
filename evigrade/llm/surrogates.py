"""PII surrogates: keyed replacements of the same type and format.

Every entity is replaced by the image of a keyed permutation of all strings of
its format: a Feistel network over the mixed-radix number that its changeable
characters spell.  Different entities of one format so get different
surrogates, and the same entity the same one wherever it stands.  Cards keep
their Luhn verdict, addresses stay private or public, phones keep country and
area, names keep script, gender and a consistent surname.

Given names come from pools and small formats may hit another entity's real
value, so collisions are checked over the corpus: a pass gathers the entities of
every text, and those whose surrogate is another's surrogate or anybody's real
value take the next attempt, until none is left.  Surnames are settled first, so
all mentions of one share a surrogate.  A given name tries its whole pool and is
then permuted.  The exceptions are a table, joined to the texts that have them
for the second pass, which rewrites the texts.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evigrade.llm.skew import unused
from evigrade.session import cut

KEY = b"evigrade-surrogates-1"
#: Attempts in a row without fewer collisions after which there is no way out: a format has no free values.
STUCK = 40

_TITLES = {
    "Mr": "m", "Herr": "m", "Sr": "m", "Señor": "m", "Monsieur": "m", "Mister": "m", "Sir": "m", "Господин": "m", "Κύριος": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Sra": "f", "Señora": "f", "Mme": "f", "Madame": "f",
    "Госпожа": "f", "Κυρία": "f", "Dr": "n", "Prof": "n",
}
_UPPER = "A-ZÀ-ÖØ-ÞА-ЯΑ-Ω"
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿА-яΑ-ω"
_NAME = rf"[{_UPPER}][{_LETTER}'’-]+"

PATTERNS = (
    ("email", r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    ("aws_key", r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b"),
    ("secret", r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b\s*[=:]\s*[\"']?)(?P<secret>[A-Za-z0-9+/_\-]{8,}=*)"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("phone", r"(?<![\w.])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![\w])"
              r"|(?<![\w.])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![\w])"),
    ("ssn", r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    ("ipv4", r"(?<![\w.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![\w]|\.[0-9])"),
    ("number", r"(?<![\w.-])(?:[0-9]{9,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![\w-])"),
    ("name", rf"\b(?P<title>{'|'.join(_TITLES)})\b\.? (?P<name>{_NAME}(?: {_NAME})?)"),
)
_ALL = re.compile("|".join(f"(?P<k_{kind}>{pattern})" for kind, pattern in PATTERNS))
_MAY = re.compile(r"[@0-9]|AKIA|ASIA|(?i:password|passwd|pwd|secret|token|api.?key)|\b(?:" + "|".join(_TITLES) + r")\b\.? ")

_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
              "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
              "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ")
_ALPHABET_OF = {c: a for a in _ALPHABETS for c in a}
#: Given names by script and gender.
_GIVEN = {
    ("latin", "f"): "Clara Irene Marta Julia Helena Nora Alice Sonia Vera Laura Emma Paula".split(),
    ("latin", "m"): "Oscar Martin Bruno Felix Hugo Victor Simon Leo David Paul Anton Lucas".split(),
    ("latin", "n"): "Robin Alex Kim Sascha Dominique Andrea Noa Charlie Jona Sam Toni Luca".split(),
    ("cyrillic", "f"): "Анна Вера Ольга Нина Мария Ирина Елена Дарья".split(),
    ("cyrillic", "m"): "Иван Олег Пётр Борис Антон Павел Юрий Андрей".split(),
    ("cyrillic", "n"): "Саша Женя Валя Слава Шура Тоня Лёня Вика".split(),
    ("greek", "f"): "Ελένη Μαρία Σοφία Άννα Κατερίνα Ειρήνη".split(),
    ("greek", "m"): "Νίκος Γιώργος Πέτρος Πάνος Κώστας Σπύρος".split(),
    ("greek", "n"): "Άρης Νίκη Χάρις Ρένα Τόλης Λίνα".split(),
}

_PRIVATE = [ipaddress.IPv4Network(n) for n in ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "127.0.0.0/8")]


def _digest(*parts: str | bytes) -> int:
    text = b"\0".join(p if isinstance(p, bytes) else p.encode() for p in parts)
    return int.from_bytes(hmac.new(KEY, text, hashlib.sha256).digest(), "big")


def permute(value: int, size: int, tweak: str) -> int:
    """A keyed permutation of range(size): an unbalanced Feistel network with cycle walking."""
    if size < 2:
        return value
    a = 1
    while a * a < size:
        a *= 2
    b = -(-size // a)
    while True:
        left, right = divmod(value, b)
        for turn in range(3):
            left = (left + _digest(tweak, f"l{turn}", str(right))) % a
            right = (right + _digest(tweak, f"r{turn}", str(left))) % b
        value = left * b + right
        if value < size:
            return value


def permute_text(text: str, tweak: str, fixed: frozenset[int] = frozenset(), hexadecimal: bool = False) -> str:
    """Permute the strings of a text's format: every changeable character keeps its alphabet."""
    places, value, size, shape = [], 0, 1, []
    for i, c in enumerate(text):
        letters = "0123456789abcdef" if hexadecimal else _ALPHABET_OF.get(c)
        if i in fixed or letters is None:
            shape.append(c)
            continue
        shape.append(f"<{letters[0]}>")
        places.append((i, letters))
        value, size = value * len(letters) + letters.index(c), size * len(letters)
    value = permute(value, size, f"{tweak}|{''.join(shape)}")
    out = list(text)
    for i, letters in reversed(places):
        value, at = divmod(value, len(letters))
        out[i] = letters[at]
    return "".join(out)


def _luhn(digits: str) -> int:
    """0 for a number that passes the check."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _number(text: str, tweak: str) -> str:
    digits = [i for i, c in enumerate(text) if c.isdigit()]
    first, last = digits[0], digits[-1]
    plain = "".join(text[i] for i in digits)
    verdict = _luhn(plain)
    moved = list(permute_text(text, f"{tweak}|{verdict}", frozenset((first, last))))
    for d in "0123456789":
        moved[last] = d
        if _luhn("".join(moved[i] for i in digits)) == verdict:
            break
    return "".join(moved)


def _address(text: str, tweak: str) -> str:
    whole = ipaddress.IPv4Address(".".join(str(int(p)) for p in text.split(".")))
    for net in _PRIVATE:
        if whole in net:
            low = int(net.network_address)
            return str(ipaddress.IPv4Address(low + permute(int(whole) - low, net.num_addresses, tweak)))
    kind, value = whole.is_global, int(whole)
    while True:
        value = permute(value, 1 << 32, tweak)
        moved = ipaddress.IPv4Address(value)
        if moved.is_global == kind and not any(moved in net for net in _PRIVATE):
            return str(moved)


def _script(name: str) -> str:
    return "cyrillic" if re.search("[А-я]", name) else "greek" if re.search("[Α-ω]", name) else "latin"


def _name(text: str, tweak: str, gender: str, attempt: int, strict: bool, surname_attempt: int) -> str:
    *given, surname = text.split(" ")
    moved = [permute_text(surname, f"surname|{surname_attempt}" if surname_attempt else "surname")]
    for name in given:
        pool = _GIVEN[_script(name), gender]
        if strict or attempt >= len(pool):
            moved.insert(0, permute_text(name, tweak))
        else:
            moved.insert(0, pool[(_digest("given", "name", gender, text) + attempt) % len(pool)])
    return " ".join(moved)


@lru_cache(200_000)
def surrogate(kind: str, text: str, attempt: int = 0, strict: bool = False, surname_attempt: int = 0) -> str:
    """The replacement of one entity.  kind of a name: name_f, name_m or name_n; surname: a name's last word."""
    tweak = f"{kind}|{attempt}"
    if kind == "email":
        top = len(text) - len(text.rpartition(".")[2])
        return permute_text(text, tweak, frozenset(range(top, len(text))))
    if kind == "ipv4":
        return _address(text, tweak)
    if kind == "phone":
        digits = [i for i, c in enumerate(text) if c.isdigit()]
        return permute_text(text, tweak, frozenset(digits[: max(1, len(digits) - 7)]))
    if kind == "number":
        return _number(text, tweak)
    if kind == "aws_key":
        return permute_text(text, tweak, frozenset(range(4)))
    if kind == "iban":
        return permute_text(text, tweak, frozenset(range(4)))
    if kind == "surname":
        return _name(text, tweak, "n", 0, strict, attempt)
    if kind.startswith("name_"):
        return _name(text, tweak, kind[-1], attempt, strict, surname_attempt)
    if kind == "secret":
        return permute_text(text, tweak, hexadecimal=re.fullmatch("[0-9a-f]+", text) is not None)
    return permute_text(text, tweak)


def entities(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of every entity in a text, in order.

    A name is found after a title; then the same name, and its surname alone, are found
    wherever else they stand in the text.
    """
    found = list(_marked(text))
    names: dict[str, str] = {}
    for kind, start, end in found:
        if kind.startswith("name_"):
            name = text[start:end]
            names.setdefault(name, kind)
            names.setdefault(name.rpartition(" ")[2], "name_n")
    if names:
        again = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, sorted(names, key=len, reverse=True)))})(?!\w)")
        starts = [start for _, start, _ in found]
        for match in again.finditer(text):
            at = bisect_right(starts, match.start())
            after = at and found[at - 1][2] > match.start()
            before = at < len(starts) and starts[at] < match.end()
            if not after and not before:
                found.insert(at, (names[match[0]], match.start(), match.end()))
                starts.insert(at, match.start())
    yield from found


def _marked(text: str) -> Iterator[tuple[str, int, int]]:
    """Entities that their form or a title marks."""
    if not _MAY.search(text):
        return
    for match in _ALL.finditer(text):
        kind = match.lastgroup if match.lastgroup and match.lastgroup.startswith("k_") else None
        kind = kind or next(k for k, v in match.groupdict().items() if k.startswith("k_") and v is not None)
        kind, group = kind[2:], 0
        if kind == "secret":
            group = "secret"
        elif kind == "name":
            group, kind = "name", f"name_{_TITLES[match['title']] if ' ' in match['name'] else 'n'}"
        yield kind, match.start(group), match.end(group)


def _normal(kind: str, text: str) -> str:
    """The form that decides whether two mentions are one entity."""
    return text.lower() if kind == "email" else text


def find_entities(docs: DataFrame) -> DataFrame:
    """(text_key, kind, entity) of all whole texts; a name also has a row of kind surname."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for kind, start, end in entities(text) if text else ():
                    name = _normal(kind, text[start:end])
                    found.add((key, kind, name))
                    if kind.startswith("name_"):
                        found.add((key, "surname", name.rpartition(" ")[2]))
            types = (pa.int64(), pa.string(), pa.string())
            columns = [pa.array([row[i] for row in found], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, names=["text_key", "kind", "entity"])

    return docs.select(text_key(), "text").mapInArrow(run, "text_key long, kind string, entity string")


def text_key() -> Column:
    """What texts meet their exceptions by; two texts of one key just get both's exceptions."""
    return F.xxhash64("text").alias("text_key")


def _assign(known: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [surrogate(k, e, n, False, s) for k, e, n, s in zip(*(batch.column(i).to_pylist() for i in range(4)))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.string())], names=["kind", "entity", "attempt", "surname_attempt", "surrogate"]
            )

    return known.select("kind", "entity", "attempt", "surname_attempt").mapInArrow(
        run, "kind string, entity string, attempt int, surname_attempt int, surrogate string"
    )


def _settle(known: DataFrame, values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Give every (kind, entity, surname_attempt) the first attempt whose surrogate is no other's and none of the values.

    Returns (kind, entity, attempt) of the attempts above 0, and the values with all surrogates.
    """
    attempt, fewest, stuck, late = 0, None, 0, None
    while True:
        made = cut(_assign(known.withColumn("attempt", F.lit(attempt))))
        # values are only asked for what was made; they come first, so their surrogates stay
        met = values.join(made.select("surrogate").distinct(), "surrogate", "left_semi")
        claims = made.select("surrogate", F.struct(F.lit(1).alias("rank"), "kind", "entity").alias("claim"))
        held = met.select("surrogate", F.struct(F.lit(0).alias("rank"), F.lit("").alias("kind"), F.lit("").alias("entity")).alias("claim"))
        first = claims.union(held).groupBy("surrogate").agg(F.min("claim").alias("first"))
        judged = made.join(first, "surrogate")
        mine = F.struct(F.lit(1).alias("rank"), "kind", "entity")
        judged = cut(judged.withColumn("good", F.col("first") == mine).drop("first"))
        good, bad = judged.where("good"), judged.where("not good")
        values = values.union(good.select("surrogate"))
        if attempt:
            late = good if late is None else late.union(good)
        n = bad.count()
        if not n:
            break
        stuck = 0 if fewest is None or n < fewest else stuck + 1
        fewest = n if fewest is None else min(n, fewest)
        if stuck >= STUCK:
            raise RuntimeError(f"{n} entities have no free surrogate, as {bad.first()['kind']}")
        known, attempt = bad.select("kind", "entity", "surname_attempt"), attempt + 1
    late = judged.where("attempt > 0") if late is None else late
    return late.select("kind", "entity", "attempt"), values


def find_exceptions(found: DataFrame) -> DataFrame:
    """(kind, entity, attempt): the attempts above 0 of find_entities()' entities and surnames."""
    known = cut(found.select("kind", "entity").distinct())
    real = cut(known.select(F.col("entity").alias("surrogate")).distinct())
    surnames, values = _settle(known.where("kind = 'surname'").withColumn("surname_attempt", F.lit(0)), real)
    # a name of one word is its surname, which is settled
    rest = known.where("kind <> 'surname' and not (kind like 'name%' and instr(entity, ' ') = 0)")
    last = F.when(F.col("kind").startswith("name_"), F.substring_index("entity", " ", -1))
    late = surnames.select(F.col("entity").alias("surname"), F.col("attempt").alias("surname_attempt"))
    rest = rest.withColumn("surname", last).join(late, "surname", "left")
    names, _ = _settle(rest.select("kind", "entity", F.coalesce("surname_attempt", F.lit(0)).alias("surname_attempt")), values)
    return cut(surnames.union(names))


def resolve_collisions(docs: DataFrame) -> tuple[dict[tuple[str, str], int], bool]:
    """find_exceptions() of a small table for rewrite(), and False: no given name is permuted before its pool is tried."""
    rows = find_exceptions(cut(find_entities(docs))).collect()
    return {(r["kind"], r["entity"]): r["attempt"] for r in rows}, False


def rewrite(text: str, attempts: dict[tuple[str, str], int], strict: bool = False) -> tuple[str, list[str]]:
    """A text with surrogates, and the kinds of what was replaced."""
    parts, at, kinds = [], 0, []
    for kind, start, end in entities(text):
        name = _normal(kind, text[start:end])
        of_surname = attempts.get(("surname", name.rpartition(" ")[2]), 0) if attempts and kind.startswith("name_") else 0
        parts += [text[at:start], surrogate(kind, name, attempts.get((kind, name), 0), strict, of_surname)]
        at = end
        kinds.append(kind.partition("_")[0] if kind.startswith("name") else kind)
    if not kinds:
        return text, kinds
    return "".join([*parts, text[at:]]), kinds


def replace_pii(docs: DataFrame) -> DataFrame:
    """docs with every detected entity replaced, and columns n_entities and entity_kinds.

    text is rewritten, other columns stay as they are; n_entities and entity_kinds
    replace columns of those names.  Null texts stay null and have no entities, nor do
    empty ones; rows that repeat a doc_id are rewritten each; a column may have any other name.
    Equal entities have equal surrogates in all rows, different ones different.
    An empty table gives an empty result.  Raises where a format has no free values left.
    """
    found = cut(find_entities(docs))
    late = F.struct("kind", "entity", "attempt")
    exceptions = found.join(find_exceptions(found), ["kind", "entity"]).groupBy("text_key").agg(F.collect_set(late).alias("_late"))
    key, mine, theirs = (unused(n, docs.columns) for n in ("own_key", "late", "text_key"))
    exceptions = cut(exceptions.select(F.col("text_key").alias(theirs), F.col("_late").alias(mine)))
    docs_late = docs.withColumn(key, text_key()).join(exceptions, F.col(key) == F.col(theirs), "left")
    kept = [c for c in docs.columns if c not in ("text", "n_entities", "entity_kinds")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            late = [{(x["kind"], x["entity"]): x["attempt"] for x in row or ()} for row in batch.column(mine).to_pylist()]
            texts = batch.column("text").to_pylist()
            done = [rewrite(t, known) if t is not None else (None, []) for t, known in zip(texts, late)]
            columns = [batch.column(c) for c in kept]
            columns.append(pa.array([t for t, _ in done], pa.string()))
            columns.append(pa.array([len(k) for _, k in done], pa.int32()))
            columns.append(pa.array([",".join(sorted(set(k))) for _, k in done], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "text", "n_entities", "entity_kinds"])

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*kept).dtypes)
    schema += ", " * bool(kept) + "text string, n_entities int, entity_kinds string"
    done = docs_late.select(*kept, "text", mine).mapInArrow(run, schema)
    return done.select(*[c for c in docs.columns if c not in ("n_entities", "entity_kinds")], "n_entities", "entity_kinds")
