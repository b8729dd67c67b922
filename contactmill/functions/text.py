"""Normalisers and text measures as column expressions; nothing here leaves the JVM.

"Missing" is the empty string throughout; a null input counts as missing.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space, and characters that have no width.
WHITE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
ZERO_WIDTH = "\u200b\u200c\u200d\u2060\ufeff"
# The shape of an e-mail address and of an E.164 number.
EMAIL = (
    r"^[a-z0-9_%+'-]+(\.[a-z0-9_%+'-]+)*@([\p{L}\p{N}]+(-+[\p{L}\p{N}]+)*\.)+"
    r"([\p{L}\p{Nl}\p{No}]{2,}|xn--[a-z0-9-]*[a-z0-9])\z"
)
E164 = r"^\+[1-9][0-9]{8,14}\z"
PHONE_LABELS = "tel telefon phone mobil mobile handy fon"
# Name particles that stay in lower case, vowels, neighbours on the keyboard.
PARTICLES = "von van vom zu zur de der den di da du la le ten ter"
VOWELS = "aeiouyøæœ"
KEYBOARD = "asdf sdfg dfgh fghj ghjk hjkl qwer qwert yxcv xcvb cvbn vbnm rtzu tzui"


def bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is written and computed once, however often f refers to it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def clean_text(value: Column) -> Column:
    """Zero-width characters go, runs of white space become one space, both ends are trimmed."""
    visible = F.translate(F.coalesce(value.cast("string"), F.lit("")), ZERO_WIDTH, "")
    return F.trim(F.regexp_replace(visible, WHITE, " "))


def _strip(value: Column, pattern: str) -> Column:
    return F.regexp_replace(value, pattern, "")


def normalize_email(raw: Column) -> Column:
    """The bare address in lower case, or "" where there is none."""

    def bare(value: Column) -> Column:
        inner = F.regexp_extract(value, r"< ?([^<> ]+) ?>", 1)
        text = _strip(F.coalesce(F.nullif(inner, F.lit("")), value), r"^[<> ]+|[<> ]+\z")
        return _strip(_strip(text, "^mailto:"), r"[.,; ]+\z")

    return bind(bind(F.lower(clean_text(raw)), bare), lambda v: F.when(v.rlike(EMAIL), v).otherwise(""))


def is_valid_email(value: Column) -> Column:
    return F.coalesce(value, F.lit("")).rlike(EMAIL)


def phone_text(raw: Column) -> Column:
    """The cleaned number without a leading label and without optional trunk zeros."""
    labels = "|".join(PHONE_LABELS.split())
    value = _strip(clean_text(raw), rf"^(?i:{labels})(?![\p{{L}}\p{{N}}_])\.? ?:? ?")
    return _strip(value, r"\( ?0 ?\)")


def normalize_phone(raw: Column, country_code: str = "49") -> Column:
    """E.164, or "" where the value is no number; digits are ASCII digits."""
    code = country_code

    def international(value: Column, digits: Column) -> Column:
        return (
            F.when(value.startswith("+"), digits)
            .when(digits.startswith("00"), F.substr(digits, F.lit(3)))
            .when(digits.startswith("0") & value.rlike(rf"^\(?0{code}[ ./)-]"), F.substr(digits, F.lit(2)))
            .when(digits.startswith("0"), F.concat(F.lit(code), F.substr(digits, F.lit(2))))
            .when(digits.startswith(code) & (F.length(digits) >= 10), digits)
            .otherwise("")
        )

    def written(number: Column) -> Column:
        usable = ~number.startswith("0") & F.length(number).between(9, 15)
        return F.when(usable, F.concat(F.lit("+"), number)).otherwise("")

    def parsed(value: Column) -> Column:
        number = bind(_strip(value, "[^0-9]"), lambda digits: international(value, digits))
        number = bind(F.regexp_replace(number, f"^{code}0", code), written)
        return F.when(value.rlike(r"[^0-9 +()./\-\u2010-\u2015]"), "").otherwise(number)

    return bind(phone_text(raw), parsed)


def is_valid_phone(value: Column, country_code: str = "49") -> Column:
    value = F.coalesce(value, F.lit(""))
    return value.rlike(E164) & ~value.startswith(f"+{country_code}0")


def _title(word: Column) -> Column:
    """Upper case for each letter that follows no letter, lower case for the others."""
    return F.array_join(F.transform(F.regexp_extract_all(word, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1)), F.initcap), "")


def normalize_name(raw: Column) -> Column:
    """White space collapsed; case mended where a name is all in upper or all in lower case."""

    def mended(value: Column) -> Column:
        words = F.transform(
            F.split(F.lower(value), " "),
            lambda w, i: F.when((i > 0) & w.isin(*PARTICLES.split()), w).otherwise(_title(w)),
        )
        one_case = (F.upper(value) == value) != (F.lower(value) == value)
        return F.when((F.length(_strip(value, r"\P{L}")) >= 4) & one_case, F.array_join(words, " ")).otherwise(value)

    return bind(clean_text(raw), mended)


_DAY, _MONTH, _YEAR = r"(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])", r"(1[0-2]|0[1-9]|[1-9])", r"([0-9]{4})"
_HOUR, _SIXTY = r"(?:2[0-3]|[01][0-9]|[0-9])", r"(?:[0-5][0-9]|[0-9])"
ISO_DATE = rf"^{_YEAR}-{_MONTH}-{_DAY}(?:[Tt ]{_HOUR}:{_SIXTY}:{_SIXTY})?\z"
GERMAN_DATE = rf"^{_DAY}\.{_MONTH}\.{_YEAR}(?: {_HOUR}:{_SIXTY})?\z"


def parse_date(raw: Column) -> Column:
    """A date from ISO or German notation with an optional time; null where there is none."""

    def fields(value: Column, pattern: str, places: tuple[int, int, int]) -> Column:
        year, month, day = (F.regexp_extract(value, pattern, i) for i in places)
        return F.concat_ws("-", year, month, F.trim(day))

    def parsed(value: Column) -> Column:
        text = F.when(value.rlike(ISO_DATE), fields(value, ISO_DATE, (1, 2, 3)))
        return text.when(value.rlike(GERMAN_DATE), fields(value, GERMAN_DATE, (3, 2, 1)))

    # there is no year 0
    return bind(bind(clean_text(raw), parsed), lambda t: F.when(~t.startswith("0000"), F.try_to_date(t, "yyyy-M-d")))


def iso_date(raw: Column) -> Column:
    return F.coalesce(F.date_format(parse_date(raw), "yyyy-MM-dd"), F.lit(""))


_HANGUL = (0xAC00, 0xD7A4)


@lru_cache(maxsize=1)
def _base_letters() -> tuple[str, str, dict[str, str]]:
    """(characters, the base letter of each, characters with several), by compatibility decomposition
    of all characters but Hangul syllables, whose parts follow from arithmetic."""
    single, several, gone = [], {}, []
    for code in (*range(0x80, 0xD800), *range(0xE000, 0x20000), *range(0x2F800, 0x2FA20)):
        char = chr(code)
        split = unicodedata.normalize("NFKD", char)
        if split == char or _HANGUL[0] <= code < _HANGUL[1]:
            continue
        plain = "".join(c for c in split if c.isalpha() and not unicodedata.combining(c))
        if len(plain) > 1:
            several[char] = plain
        elif plain and plain != char:
            single.append((char, plain))
        elif not plain and char.isalpha():
            gone.append(char)
    # characters without a counterpart are deleted
    return "".join(a for a, _ in single) + "".join(gone), "".join(b for _, b in single), several


def _char_class(chars) -> str:
    """A regular expression's class of the characters, as ranges."""
    codes, runs = sorted(map(ord, chars)), []
    for code in codes:
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs) + "]"


def _each(value: Column, f: Callable[[Column], Column]) -> Column:
    """The text with f of each of its characters."""
    return F.array_join(F.transform(F.regexp_extract_all(value, F.lit("(?s)(.)"), F.lit(1)), f), "")


def _syllable(char: Column) -> Column:
    """The parts of a Hangul syllable."""
    number = F.ascii(char) - _HANGUL[0]

    def part(first: int, count: int, at: Column) -> Column:
        return F.substr(F.lit("".join(map(chr, range(first, first + count)))), at.cast("int") + 1, F.lit(1))

    last = F.pmod(number, F.lit(28))
    end = F.when(last > 0, part(0x11A8, 27, last - 1)).otherwise("")
    return F.concat(part(0x1100, 19, F.floor(number / 588)), part(0x1161, 21, F.floor(F.pmod(number, F.lit(588)) / 28)), end)


def letters(text: Column) -> Column:
    """Base letters, those of the text in lower case, without accents; all else goes."""
    single, base, several = _base_letters()
    # one literal, that the optimiser makes a map of: neither side is ever a comma or a colon
    spelled = F.str_to_map(F.lit(",".join(f"{a}:{b}" for a, b in several.items())), F.lit(","), F.lit(":"))
    rare, korean = _char_class(several), f"[{chr(_HANGUL[0])}-{chr(_HANGUL[1] - 1)}]"

    def plain(value: Column) -> Column:
        whole = _each(value, lambda c: F.when(c.rlike(korean), _syllable(c)).otherwise(F.coalesce(F.try_element_at(spelled, c), c)))
        return F.when(value.rlike(f"{rare}|{korean}"), whole).otherwise(value)

    return _strip(bind(F.translate(F.lower(F.coalesce(text, F.lit(""))), single, base), plain), r"\P{L}")


def name_letters(name: Column) -> Column:
    """The letters of a name without its initials."""
    words = F.filter(F.split(F.coalesce(name, F.lit("")), " "), lambda w: ~w.rlike(r"^[\p{L}\p{N}_]\.?\z"))
    return letters(F.array_join(words, " "))


def vowel_ratio(base: Column) -> Column:
    """The share of vowels among base letters; 1 where there are none."""
    share = F.try_divide(F.length(_strip(base, f"[^{VOWELS}]")), F.length(base))
    return F.coalesce(share, F.when(base.isNotNull(), F.lit(1.0)))


def percent(ratio: Column) -> Column:
    """A whole percentage, halves to even, with a space before the sign."""
    return F.concat(F.bround(ratio * 100).cast("int").cast("string"), F.lit(" %"))


def thousands(number: Column) -> Column:
    """1326 -> 1.326"""
    return F.replace(F.format_number(number, 0), F.lit(","), F.lit("."))


def slug(text: Column) -> Column:
    """ASCII letters and digits in lower case, German letters spelled out, other accents dropped."""
    value = F.lower(F.coalesce(text, F.lit("")))
    for letter, spelled in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        value = F.replace(value, F.lit(letter), F.lit(spelled))
    single, base, _ = _base_letters()
    return _strip(F.translate(value, "¹²³" + single, "123" + base), "[^a-z0-9]")


def escape_html(text: Column) -> Column:
    """Text that is safe in HTML, also within quotes."""
    value = F.coalesce(text, F.lit(""))
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        value = F.replace(value, F.lit(mark), F.lit(name))
    return value


def casefold(text: Column) -> Column:
    # the empty string keeps the optimiser from taking lower(upper(x)) for lower(x)
    return F.lower(F.concat(F.upper(F.replace(text, F.lit("ẞ"), F.lit("SS"))), F.lit("")))


def quoted(value: Column) -> Column:
    """A value in quotes, as Python writes a string: in double quotes if it has single ones only,
    and with escapes for backslashes and for what can't be printed."""
    unprintable = r"[\p{C}\p{Z}&&[^ ]]"

    def escape(char: Column) -> Column:
        code = F.ascii(char)
        number = F.lower(F.hex(code))
        short = F.concat(F.lit("\\x"), F.lpad(number, 2, "0"))
        long_ = F.concat(F.lit("\\U"), F.lpad(number, 8, "0"))
        form = F.when(code < 0x100, short).when(code < 0x10000, F.concat(F.lit("\\u"), F.lpad(number, 4, "0"))).otherwise(long_)
        return F.when(char.rlike(unprintable), form).otherwise(char)

    def marked(escaped: Column) -> Column:
        one = escaped.contains("'")
        inner = F.when(one & escaped.contains('"'), F.replace(escaped, F.lit("'"), F.lit("\\'"))).otherwise(escaped)
        mark = F.when(one & ~escaped.contains('"'), '"').otherwise("'")
        return F.concat(mark, inner, mark)

    plain = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    return bind(F.when(value.rlike(unprintable), _each(plain, escape)).otherwise(plain), marked)
