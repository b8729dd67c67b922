"""PII: personal data and credentials are replaced by keyed, type-consistent surrogates.

Found are e-mail addresses, telephone numbers, IPv4 addresses, payment card numbers (by issuer
prefix and check digit), social security numbers, credentials after a telling name (any value after
password, passwd or pwd; after other names 16 letters, digits or _-+/, or 8 with a digit), and
personal names after a form of address or a known given name.

All but names are replaced by a keyed permutation of their own format: letters stay letters of the
same script and case, digits stay digits, separators stay, check digits are right. A permutation
never gives two entities one surrogate and never keeps an entity as it is, in a space of any size
and without any coordination between tasks. An address keeps its host's identity: equal hosts get
equal hosts, below example.com, .net or .org. A surrogate may be what another entity was called
before; that entity has got another name by then.

Names are made up from a keyed hash, with the gender and script of the original. Whether two names
drew the same one is checked over all distinct names of the corpus; of those that did, all but the
first get further syllables that tell them apart, in one pass.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import prod

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contactmill.session import BROADCAST_BYTES, bounded_batches, broadcast_if_small, discard, materialise, unused

KEY = b"contactmill surrogate key"
#: Bytes of a row of the table of names that are told apart, in a worker's memory.
NAME_ROW = 200

# Given names by gender, forms of address by gender, names of credentials.
GIVEN = {
    "f": "Anna Maria Mary Emma Julia Laura Sarah Lisa Sofia Elena Carmen Lucia Claire Camille Sophie Marie Katharina "
    "Susanne Petra Linda Patricia Jennifer Elizabeth Barbara Анна Мария Елена Ольга Наталья",
    "m": "John James Robert Michael William David Thomas Peter Paul Hans Klaus Juan Carlos Pedro Pierre Jean Jacques "
    "Stefan Martin Daniel George Richard Charles Иван Сергей Алексей Дмитрий Андрей",
}
ADDRESS = {
    "m": "Mr Herr Herrn Señor Monsieur Sir",
    "f": "Mrs Ms Miss Frau Señora Señorita Madame Mme Mademoiselle",
    "": "Dr Prof",
}
CREDENTIALS = r"(?:api[_-]?key|access[_-]?key|secret(?:[_-]?key)?|auth[_-]?token|token|(?P<own>passwd|password|pwd))"

_GENDER = {n.lower(): g for g, names in GIVEN.items() for n in names.split()}
_TITLE_GENDER = {n: g for g, names in ADDRESS.items() for n in names.split()}
_NAME = r"[A-ZÀ-ÖØ-ÞА-Я][\w’'-]*[a-zß-öø-ÿа-я][\w’'-]*|[A-ZÀ-ÖØ-ÞА-Я]{2,}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_PATTERNS = {
    # a password is all between quotes, or else up to white space or closing marks (on the next line only
    # with a quote or a digit); the value of other names has 16 characters, or 8 with a digit
    "secret": re.compile(
        CREDENTIALS + r"""["']?\s*[:=](?(own)(?:[^\S\n]*|\s*(?=["']|\S*\d))|\s*)(?P<q>["'])?(?P<v>(?(own)"""
        r"""(?:(?(q)(?:\\.|(?!(?P=q))[^\\\n])++(?=(?P=q))|(?!))|[^\s"']\S*(?<![.,;:)\]}>"']))"""
        r"""|(?:[A-Za-z0-9_\-+/]{16,}|(?=[A-Za-z_\-+/]*\d)[A-Za-z0-9_\-+/]{8,})={0,2}))""",
        re.I,
    ),
    # from the @ on; _emails looks for what stands before it
    "email": re.compile(r"(?P<v>@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,})"),
    "ip": re.compile(rf"(?<![\d.])(?P<v>(?:{_OCTET}\.){{3}}{_OCTET})(?!\d|\.\d)"),
    # all numbers that single blanks or hyphens join; _cards looks for cards among them
    "card": re.compile(r"(?<!\d)(?P<v>\d(?:[ -]?\d){12,})"),
    "ssn": re.compile(r"(?<![\d-])(?P<v>(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4})(?![\d-])"),
    "phone": re.compile(
        r"(?<![\w+])(?P<v>\+\d{1,3}(?:[ .\-/]?\(?\d{1,5}\)?){2,6}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)"
    ),
    "name": re.compile(
        rf"\b(?:(?P<title>{'|'.join(_TITLE_GENDER)})\b\.? ?|(?=(?:{'|'.join(n for n in ' '.join(GIVEN.values()).split())})\s))"
        rf"(?P<v>(?:{_NAME})(?: (?!(?:{'|'.join(_TITLE_GENDER)})\b)(?:{_NAME})){{0,2}})"
    ),
}
TYPES = tuple(_PATTERNS)
NAMES = ("given_f", "given_m", "given_n", "surname")
_LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_%+'-."
_DIGITS = re.compile(r"[0-9@]")
_LAST_NUMBER = re.compile(r"[ .\-/(]*\d+\)?$")
#: Every name of a credential has one of these.
_QUICK_SECRET = ("passw", "pwd", "token", "secret", "key")
# no look-behind: a pattern that starts with letters is searched for by its possible first letters
_QUICK_NAME = re.compile(f"(?:{'|'.join([*_TITLE_GENDER, *' '.join(GIVEN.values()).split()])})(?!\\w)")
_ISSUERS = re.compile(
    r"4(?:\d{12}|\d{15}|\d{18})|5[1-5]\d{14}|2(?:2[2-9]|[3-6]\d|7[01])\d{13}|3[47]\d{13}|3(?:0[0-5]|[68]\d)\d{11}"
    r"|6(?:011|5\d\d|4[4-9]\d)\d{12}|35(?:2[89]|[3-8]\d)\d{12}"
)


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of those before it."""
    total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


@dataclass(frozen=True)
class Entity:
    start: int
    stop: int
    type: str
    canonical: str
    gender: str = ""


def find(text: str, types: tuple[str, ...] = TYPES) -> list[Entity]:
    """The entities of a text in order; where two overlap, the type named first in TYPES has it.

    Takes time in proportion to the text, whatever is in it."""
    numbers, names = _DIGITS.search(text), _QUICK_NAME.search(text)
    lower = text.lower()
    secret = "secret" in types and any(x in lower for x in _QUICK_SECRET)
    if not (numbers or names or secret):
        return []
    found: list[Entity] = []
    for kind in TYPES:
        if kind not in types or not (names if kind == "name" else secret if kind == "secret" else numbers):
            continue
        # what lies between entities is searched by itself, so none hides what stands beside it
        for a, b in _gaps(found, len(text)):
            low = a
            for m in _PATTERNS[kind].finditer(text, a, b):
                start, stop = m.span("v")
                value = m.group("v")
                if kind == "email":
                    start = _local_start(text, low, start)
                    low = stop
                    if start < m.start():
                        found.append(Entity(start, stop, kind, text[start:stop].lower()))
                elif kind == "card":
                    found += _cards(value, start)
                elif kind == "phone":
                    digits = re.sub(r"\D", "", value)
                    while len(digits) > 15:  # numbers after it are left off
                        value = value[: _LAST_NUMBER.search(value).start()]
                        digits = re.sub(r"\D", "", value)
                    if len(digits) >= 8:
                        found.append(Entity(start, start + len(value), kind, ("+" if value[0] == "+" else "") + digits))
                elif kind == "name":
                    found += _name_parts(value, start, m.group("title"))
                else:
                    found.append(Entity(start, stop, kind, value))
    found.sort(key=lambda e: e.start)
    return sorted([*found, *_surnames_alone(text, found)], key=lambda e: e.start)


def _gaps(found: list[Entity], size: int) -> list[tuple[int, int]]:
    """The parts of 0..size that no entity covers."""
    spans = sorted((e.start, e.stop) for e in found)
    return [(a, b) for a, b in zip([0, *(b for _, b in spans)], [*(a for a, _ in spans), size]) if a < b]


def _local_start(text: str, low: int, at: int) -> int:
    """Where the local part before the @ at `at` begins, not before low; at itself if there is none."""
    local = text[low:at]
    local = local[len(local.rstrip(_LOCAL)) :]
    local = local[local.rfind("..") + 2 :] if ".." in local else local
    return at if local.endswith(".") else at - len(local.lstrip("."))


def _surnames_alone(text: str, found: list[Entity]) -> Iterator[Entity]:
    """A surname that is known from this text is the same person where it stands alone."""
    known: dict[str, dict[str, str]] = {}
    for e in found:
        if e.type == "surname":
            name = text[e.start : e.stop]
            known.setdefault(_WORD.match(name).group(), {})[name] = e.canonical
    if not known:
        return
    starts, at = [e.start for e in found], 0
    for m in _WORD.finditer(text):
        if m.start() < at or m.group() not in known:
            continue
        for name, canonical in sorted(known[m.group()].items(), key=lambda x: -len(x[0])):
            stop = m.start() + len(name)
            if text.startswith(name, m.start()) and not (stop < len(text) and _WORD.match(text[stop - 1 : stop + 1], 1)):
                k = bisect.bisect_left(starts, stop)  # the last entity that starts before its end
                if not k or found[k - 1].stop <= m.start():
                    yield Entity(m.start(), stop, "surname", canonical)
                    at = stop
                    break


_WORD = re.compile(r"\w+")


def _cards(value: str, start: int) -> Iterator[Entity]:
    """Cards in a row of numbers: from each number on, the most numbers that are a card together."""
    runs = [m.span() for m in re.finditer(r"\d+", value)]
    i = 0
    while i < len(runs):
        digits, card = "", None
        for j in range(i, len(runs)):
            digits += value[slice(*runs[j])]
            if len(digits) > 19:
                break
            if len(digits) >= 13 and _ISSUERS.fullmatch(digits) and luhn(digits):
                card = j, digits
        if card:
            yield Entity(start + runs[i][0], start + runs[card[0]][1], "card", card[1])
            i = card[0]
        i += 1


def _name_parts(value: str, start: int, title: str | None) -> Iterator[Entity]:
    """Each word of a name is an entity: the last is the surname, those before it given names."""
    words = list(re.finditer(r"\S+", value))
    gender = _TITLE_GENDER.get(title or "", "")
    for k, w in enumerate(words):
        canonical = w.group().lower()
        given = _GENDER.get(canonical) or gender or "n"
        surname = k == len(words) - 1 and (len(words) > 1 or title is not None) and canonical not in _GENDER
        yield Entity(start + w.start(), start + w.end(), "surname" if surname else "given_" + given, canonical)


class _Draw:
    """Numbers from a keyed hash, the same for the same parts."""

    def __init__(self, key: bytes, *parts: str):
        self.pool = int.from_bytes(hmac.new(key, "\x1f".join(parts).encode(), hashlib.sha512).digest(), "big")

    def below(self, n: int) -> int:
        self.pool, out = divmod(self.pool, n)
        return out


class _Cycle:
    """A keyed permutation of 0..size-1 that is one cycle through all of them, so that none is its
    own image: a number is enciphered by a Feistel network, raised by one, and deciphered."""

    ROUNDS = 8

    def __init__(self, size: int, key: bytes, *parts: str):
        self.size, self.half = size, max(1, ((size - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.width = (self.half + 7) // 8
        self.key = hmac.new(key, "\x1f".join([*parts, str(size)]).encode(), hashlib.sha512).digest()

    def _round(self, k: int, x: int) -> int:
        data = x.to_bytes(self.width, "big") + bytes([k])
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=self.width).digest(), "big") & self.mask

    def _cipher(self, x: int, rounds: range) -> int:
        # walked until it is in range again, which keeps it a permutation
        while True:
            a, b = x >> self.half, x & self.mask
            for k in rounds:
                a, b = b, a ^ self._round(k, b)
            x = b << self.half | a
            if x < self.size:
                return x

    def __call__(self, x: int) -> int:
        if self.size == 1:
            return x
        x = (self._cipher(x, range(self.ROUNDS)) + 1) % self.size
        return self._cipher(x, range(self.ROUNDS - 1, -1, -1))


_MARKS = "!#$%&*?@^~"
#: Characters that are permuted at once; a longer text is permuted part by part.
_PART = 64


@lru_cache(maxsize=4096)
def _kin(c: str) -> str:
    """The characters that c may become: of the same script and case, or digits; "" where c stays."""
    for ascii_kin in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", _MARKS):
        if c in ascii_kin:
            return ascii_kin
    if c.isascii() or not (c.isalpha() or unicodedata.category(c)[0] in "NSP"):
        return ""
    block = map(chr, range(max(128, ord(c) & ~0xFF), (ord(c) | 0xFF) + 1))
    return "".join(x for x in block if unicodedata.category(x) == unicodedata.category(c))


def _permuted(text: str, key: bytes, *parts: str, kin: Callable[[str], str] = _kin) -> str:
    """The text with its characters replaced by their kin; a permutation of the texts of one format."""
    out = []
    for at in range(0, len(text), _PART):
        part = text[at : at + _PART]
        sets = [kin(c) or c for c in part]
        size = prod(map(len, sets))
        number = 0
        for c, own in zip(part, sets):
            number = number * len(own) + own.index(c)
        # a part's permutation depends on its format and on the part before it
        form = "".join(own[0] for own in sets)
        number = _Cycle(size, key, *parts, form, text[max(0, at - _PART) : at])(number)
        new = []
        for own in reversed(sets):
            number, i = divmod(number, len(own))
            new.append(own[i])
        out += reversed(new)
    return "".join(out)


def _walk(value: str, step: Callable[[str], str], holds: Callable[[str], bool]) -> str:
    """The next value for which `holds` tells the same as for this one: a permutation step that is
    kept within those values. `holds` is true or false for the values of a format as a whole."""
    want, new = holds(value), step(value)
    while holds(new) != want:
        new = step(new)
    return new


_HEXADECIMAL = re.compile(r"(?=[a-f]*\d)(?=\d*[a-f])[0-9a-f]{8,}|(?=[A-F]*\d)(?=\d*[A-F])[0-9A-F]{8,}")


def _new_secret(value: str, key: bytes) -> str:
    if _HEXADECIMAL.fullmatch(value):
        digits = "0123456789abcdef" if value == value.lower() else "0123456789ABCDEF"
        # letters and digits may change places, but some of both stay
        return _walk(value, lambda v: _permuted(v, key, "hex", kin=lambda c: digits), lambda v: bool(_HEXADECIMAL.fullmatch(v)))
    if all(len(_kin(c)) < 2 for c in value):  # nothing in it can be permuted
        draw = _Draw(key, "secret", value)
        return "x" + "".join(chr(97 + draw.below(26)) for _ in range(24))
    return _walk(value, lambda v: _permuted(v, key, "secret"), lambda v: bool(_HEXADECIMAL.fullmatch(v)))


def _new_email(value: str, key: bytes) -> str:
    local, _, host = value.partition("@")
    top = host.rpartition(".")[2]
    local, host = _permuted(local, key, "local"), _permuted(host, key, "host")
    return f"{local}@{host}.example.{top if top in ('com', 'net', 'org') else 'com'}"


def _new_ip(value: str, key: bytes) -> str:
    spans = [{1: (0, 10), 2: (10, 90), 3: (100, 156)}[len(x)] for x in value.split(".")]
    number = 0
    for octet, (first, n) in zip(value.split("."), spans):
        number = number * n + int(octet) - first
    number = _Cycle(prod(n for _, n in spans), key, "ip", str(spans))(number)
    out = []
    for first, n in reversed(spans):
        number, i = divmod(number, n)
        out.append(str(first + i))
    return ".".join(reversed(out))


def _is_card(digits: str) -> bool:
    return len(digits) >= 13 and bool(_ISSUERS.fullmatch(digits)) and luhn(digits)


def _new_card(value: str, key: bytes) -> str:
    def step(number: str) -> str:
        body = number[0] + _permuted(number[1:-1], key, "card", number[0])
        return body + next(c for c in "0123456789" if luhn(body + c))

    return _walk(value, step, lambda v: bool(_ISSUERS.fullmatch(v)))


def _new_ssn(value: str, key: bytes) -> str:
    return _walk(value, lambda v: _permuted(v, key, "ssn"), lambda v: bool(_PATTERNS["ssn"].fullmatch(v)))


def _new_phone(value: str, key: bytes) -> str:
    keep = (2 if value[1] in "17" else 3) if value[0] == "+" else 0
    head = value[:keep]
    return head + _walk(
        value[keep:], lambda v: _permuted(v, key, "phone", head), lambda v: _is_card((head + v).lstrip("+"))
    )


# Parts of made-up names, by script; each syllable and each ending has one vowel.
_ONSETS = {"latin": "b d f g k l m n p r s t v br dr gr st tr".split(), "cyrillic": "б в г д к л м н п р с т бр гр ст тр".split()}
_VOWELS = {"latin": "a e i o u".split(), "cyrillic": "а е и о у".split()}
_ENDINGS = {
    "latin": {"f": "na ra la sa".split(), "m": "ro rus nan ter".split(), "n": "ne ri li den".split(), "s": "man ski berg ton sen ger".split()},
    "cyrillic": {"f": "на ра ла са".split(), "m": "нан рис лол тей".split(), "n": "не ри ден".split(), "s": "ров син ко ский".split()},
}


def _made_name(draw: _Draw, like: str, kind: str, rank: int) -> str:
    """Three syllables, those that tell the rank of names that drew the same ones, and an ending.
    Names of different draws, ranks or kinds differ, as syllables and endings can be read back."""
    script = "cyrillic" if "Ѐ" <= like[0] <= "ӿ" else "latin"
    onset, vowel, ending = _ONSETS[script], _VOWELS[script], _ENDINGS[script][kind]
    body = "".join(onset[draw.below(len(onset))] + vowel[draw.below(5)] for _ in range(3))
    end = ending[draw.below(len(ending))]
    while rank:
        rank, i = divmod(rank - 1, len(onset) * 5)
        body += onset[i // 5] + vowel[i % 5]
    return body + end


@lru_cache(maxsize=100_000)
def surrogate(kind: str, canonical: str, rank: int = 0, key: bytes = KEY) -> str:
    """The canonical form of an entity's replacement; rank: of a name among those that drew the
    same one."""
    if kind in NAMES:
        return _made_name(_Draw(key, kind, canonical), canonical, "s" if kind == "surname" else kind[-1], rank)
    made = {"email": _new_email, "ip": _new_ip, "card": _new_card, "ssn": _new_ssn, "phone": _new_phone}
    return made.get(kind, _new_secret)(canonical, key)


def render(kind: str, original: str, new: str) -> str:
    """The surrogate `new`, written as the original is: with its separators and its case."""
    if kind in ("phone", "card"):
        digits = iter(re.sub(r"\D", "", new))
        return "".join(next(digits) if c.isdigit() else c for c in original)
    if kind == "surname" or kind.startswith("given_"):
        if original.isupper() and len(original) > 1:
            return new.upper()
        return new.capitalize() if original[0].isupper() else new
    if kind == "email" and original.isupper():
        return new.upper()
    return new


def replace(text: str, ranks: dict[tuple[str, str], int], key: bytes = KEY, types: tuple[str, ...] = TYPES):
    """(new text, number of entities, their types) of a text."""
    entities = find(text, types)
    if not entities:
        return text, 0, []
    out, at = [], 0
    for e in entities:
        new = surrogate(e.type, e.canonical, ranks.get((e.type, e.canonical), 0), key)
        out += [text[at : e.start], render(e.type, text[e.start : e.stop], new)]
        at = e.stop
    return "".join([*out, text[at:]]), len(entities), sorted({e.type for e in entities})


# ------------------------------------------------------------- over tables


def names(docs: DataFrame, text_col: str = "text", types: tuple[str, ...] = TYPES) -> DataFrame:
    """(type, canonical): the distinct names of all texts."""

    def run(batches):
        for batch in batches:
            seen = {
                (e.type, e.canonical) for t in batch.column(0).to_pylist() if t for e in find(t, types) if e.type in NAMES
            }
            if seen:
                kinds, values = zip(*sorted(seen))
                yield pa.RecordBatch.from_pydict({"type": kinds, "canonical": values})

    return docs.select(text_col).mapInArrow(run, "type string, canonical string").distinct()


def clashes(known: DataFrame, key: bytes = KEY, surrogate_of=surrogate) -> DataFrame:
    """(type, canonical, rank) of the names that drew what a name before them drew, rank from 1.

    Names that draw the same surrogate are few, as the draw is uniform: they are ranked by type and
    canonical form, and no two of one rank share a draw. So one pass makes all surrogates distinct.
    """

    @F.pandas_udf("string")
    def drawn(kind: pd.Series, canonical: pd.Series) -> pd.Series:
        return pd.Series([surrogate_of(k, c, 0, key) for k, c in zip(kind, canonical)], dtype=object)

    rows = known.select("type", "canonical", drawn("type", "canonical").alias("new"))
    rank = F.row_number().over(Window.partitionBy("new").orderBy("type", "canonical")) - 1
    return rows.withColumn("rank", rank).where("rank > 0").select("type", "canonical", "rank")


def pseudonymise(
    docs: DataFrame, text_col: str = "text", key: bytes = KEY, types: tuple[str, ...] = TYPES
) -> DataFrame:
    """All columns of docs with surrogates in text_col, and n_entities and entity_types.

    Equal entities get equal surrogates in all rows, different entities different ones. A null text
    stays null, with no entities; a text without entities stays as it is. Rows that are repeated
    get equal results. Columns of docs with the added names are replaced; other columns may have
    any name. An empty table gives an empty result. The key decides the surrogates; without it they
    tell nothing of the originals.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    added = ("n_entities", "entity_types")
    docs = docs.select(*[c for c in docs.columns if c.lower() not in added])
    table, path = materialise(clashes(names(docs, text_col, types), key), "names")
    n = table.count() if "name" in types else 0

    columns = [*docs.columns, *added]
    at = columns.index(text_col)
    source, everywhere = docs, None
    if n * NAME_ROW <= BROADCAST_BYTES:
        # few enough for all workers to know them
        everywhere = {(r["type"], r["canonical"]): r["rank"] for r in table.collect()}
    else:
        # texts with such a name carry a list of theirs
        text, listed = unused(docs.columns, "text_digest", "ranks")

        def holders(batches):
            for batch in batches:
                rows = {
                    (h, e.type, e.canonical)
                    for h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    if t
                    for e in find(t, types)
                    if e.type in NAMES
                }
                if rows:
                    fields = [pa.array(x) for x in zip(*sorted(rows))]
                    yield pa.RecordBatch.from_arrays(fields, ["digest", "type", "canonical"])

        keyed = docs.withColumn(text, F.sha2(F.coalesce(text_col, F.lit("")), 256))
        held = keyed.select(text, text_col).mapInArrow(holders, "digest string, type string, canonical string")
        held = held.distinct().join(table, ["type", "canonical"])
        held = held.groupBy(F.col("digest").alias(text)).agg(F.collect_set(F.struct("type", "canonical", "rank")).alias(listed))
        held, _ = materialise(held, "held")
        source = keyed.join(broadcast_if_small(held, held.count(), 300), text, "left").select(*docs.columns, listed)

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            lists = batch.column(batch.num_columns - 1).to_pylist() if everywhere is None else [None] * len(texts)
            new, counts, kinds = [], [], []
            for text, mine in zip(texts, lists):
                ranks = everywhere if everywhere is not None else {(x["type"], x["canonical"]): x["rank"] for x in mine or ()}
                done = replace(text, ranks, key, types) if text else (text, 0, [])
                new.append(done[0])
                counts.append(done[1])
                kinds.append(",".join(done[2]))
            fields = [batch.column(i) for i in range(len(columns) - 2)]
            fields[at] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*fields, pa.array(counts, pa.int32()), pa.array(kinds, pa.string())], columns
            )

    schema = docs.select("*", F.lit(0).alias("n_entities"), F.lit("").alias("entity_types")).schema
    for field in schema.fields:
        field.nullable = True
    if everywhere is not None:
        discard(spark, path)
    return source.mapInArrow(run, schema)
