"""String functions. All are built-in expressions, but for nfkc(), which Spark doesn't have."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Extensions that count as known documents.
EXTENSIONS = ("pdf", "hwp", "hwpx", "xls", "xlsx", "doc", "docx", "zip")
# Separators and brackets of item lists, characters trimmed from items.
SEPARATORS = ("\n", "\r", "/", ",", "，")
OPENING, CLOSING, TRIMMED = "([（", ")]）", " ·•\t"


@F.pandas_udf(StringType())
def nfkc(values: pd.Series) -> pd.Series:
    """Unicode compatibility composition, in Arrow batches."""
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with the value made once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), 0)


def collapse(c: Column) -> Column:
    """White-space runs become one space; trimmed."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), r"^ | $", "")


def normalize_space(c: Column) -> Column:
    return collapse(nfkc(c))


def squeeze(c: Column) -> Column:
    """Comparison form of normalised text: no white space at all."""
    return F.regexp_replace(c, r"(?U)\s+", "")


def compact(c: Column) -> Column:
    return squeeze(nfkc(c))


def alias_key(c: Column) -> Column:
    """Key under which aliases are looked up: outer brackets, spaces, dots, underscores and hyphens go; lower case."""
    bare = F.regexp_replace(collapse(c), r"^[\[【](.*?)[\]】]$", "$1")
    return F.lower(F.regexp_replace(bare, r"[\s._-]+", ""))


def canonical_name(c: Column, drop: tuple[str, ...] = ("(구)성동구치소", "(민영)")) -> Column:
    out = F.replace(collapse(c), F.lit(" "), F.lit(""))
    for x in drop:
        out = F.replace(out, F.lit(x), F.lit(""))
    return out


def bracket_prefix(c: Column, default: str = "unknown") -> Column:
    """Text of a leading [ ... ]."""
    return F.coalesce(F.nullif(F.trim(F.regexp_extract(c, r"^\s*\[([^\]]*)\]", 1)), F.lit("")), F.lit(default))


def bracket_tokens(c: Column) -> Column:
    """All [ ... ] tokens of a title, in order."""
    return F.regexp_extract_all(c, F.lit(r"\[([^\]]*)\]"), F.lit(1))


def extension(c: Column, known: tuple[str, ...] = EXTENSIONS) -> Column:
    """Extension of a file name or URL path, or 'unknown'."""
    path = F.regexp_replace(F.regexp_replace(c, r"[?#].*$", ""), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*", "")
    found = F.lower(F.regexp_extract(path, r"[^/]\.([^./\\]+)$", 1))
    return F.when(found.isin(*known), found).otherwise(F.lit("unknown"))


def safe_filename(c: Column, longest: int = 180, default: str = "attachment.bin") -> Column:
    name = F.regexp_replace(collapse(F.regexp_extract(c, r"([^/]*)$", 1)), r'[<>:"/\\|?*\x00-\x1f]', "_")
    name = F.regexp_replace(name, r"^[ .]+|[ .]+$", "")
    return F.coalesce(F.nullif(F.substring(name, 1, longest), F.lit("")), F.lit(default))


def slug(c: Column, default: str = "unknown") -> Column:
    out = F.regexp_replace(F.regexp_replace(F.lower(collapse(c)), "[^0-9a-z가-힣]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(out, F.lit("")), F.lit(default))


def name_pattern(c: Column, longest: int = 80) -> Column:
    """File-name shape: digits to #, separators to one space."""
    return F.substring(F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"\d+", "#"), r"[\s_.-]+", " ")), 1, longest)


def sheet_key(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"\s+", ""), r"\d+", "#")


def absolute_url(link: Column, base: Column) -> Column:
    """link resolved against base: absolute, host-relative or relative to the folder."""
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    folder = F.concat(root, F.coalesce(F.nullif(F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/(?:[^?#]*/)?)", 1), F.lit("")), F.lit("/")))
    return F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), link).when(link.startswith("/"), F.concat(root, link)).otherwise(F.concat(folder, link))


def link_id(c: Column, keys: tuple[str, ...] = ("id", "no", "seq")) -> Column:
    """Id of a link: a call's first number, else a query key, else the last number of the path."""
    ways = [F.regexp_extract(c, r"\w+\(\s*'?(\d+)", 1)]
    ways += [F.regexp_extract(c, rf"[?&]{k}=(\d+)", 1) for k in keys]
    ways.append(F.regexp_extract(c, r"/(\d+)(?:[^/\d]*)$", 1))
    return F.coalesce(*[F.nullif(w, F.lit("")) for w in ways])


# How links, scripts and queries of the site name a post.
POST_CALL, POST_PATH, POST_KEYS = r"jf_viewArtcl\(\s*['\"][^'\"]+['\"]\s*,\s*['\"](\d+)['\"]\s*\)", r"/(\d+)/artclView\.do", ("artclSeq", "articleNo", "nttId")


def post_id(c: Column) -> Column:
    """Id of a post in a link or script: the call's, else the path's, else a query key's, else a key's with any separator."""
    ways = [F.regexp_extract(c, POST_CALL, 1), F.regexp_extract(c, POST_PATH, 1), *[F.regexp_extract(c, rf"[?&]{k}=([^&#]+)", 1) for k in POST_KEYS]]
    ways.append(F.regexp_extract(c, rf"(?:{'|'.join(POST_KEYS)})[=,'\"\s]+(\d+)", 1))
    return F.coalesce(*[F.nullif(w, F.lit("")) for w in ways])


def short_id(c: Column, n: int = 24) -> Column:
    return F.substring(F.sha2(c, 256), 1, n)


def a1_row(c: Column) -> Column:
    return F.regexp_extract(c, r"^[A-Z]+(\d+)$", 1).try_cast("int")


def a1_column(c: Column) -> Column:
    """Number of an A1 column: base 26 over A-Z."""
    letters = F.split(F.regexp_extract(c, r"^([A-Z]+)\d+$", 1), "")
    return F.aggregate(F.filter(letters, lambda x: x != ""), F.lit(0), lambda a, x: a * 26 + F.ascii(x) - 64)


def cell_text(value: Column, kind: str) -> Column:
    """Text of a cell's value of a Spark type: nothing for null, ISO for dates and times, else the stripped text."""
    if kind == "date":
        out = value.cast("string")
    elif kind.startswith("timestamp"):
        out = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    else:
        out = F.regexp_replace(value.cast("string"), r"(?U)^\s+|\s+$", "")
    return F.coalesce(out, F.lit(""))


def a1(row: Column, column: Column) -> Column:
    """A1 coordinate of a cell; columns up to ZZZ."""
    n = column.cast("int") - 1
    letter = lambda k: F.char(F.lit(65) + F.pmod(k, F.lit(26)).cast("int"))
    two, three = F.floor(n / 26) - 1, F.floor((F.floor(n / 26) - 1) / 26) - 1
    head = F.concat(F.when(three >= 0, letter(three)).otherwise(F.lit("")), F.when(two >= 0, letter(two)).otherwise(F.lit("")))
    return F.concat(head, letter(n), row.cast("string"))


def split_items(c: Column) -> Column:
    """Items of a list text: split on separators outside brackets, trimmed, empty ones dropped.

    A bracket that isn't closed suppresses all later splits; a closing one at depth 0 is ordinary. The slash inside the
    spreadsheet errors #DIV/0! and #N/A is none.
    """
    masked = F.regexp_replace(F.regexp_replace(F.trim(c), r"(?i)(#DIV)/(0!)", "$1\ue000$2"), r"(?i)(#N)/(A)", "$1\ue000$2")
    zero = F.struct(F.lit(0).alias("depth"), F.lit("").alias("now"), F.array().cast("array<string>").alias("done"))

    def step(s: Column, x: Column) -> Column:
        depth = F.when(F.lit(OPENING).contains(x), s["depth"] + 1).when(F.lit(CLOSING).contains(x) & (s["depth"] > 0), s["depth"] - 1).otherwise(s["depth"])
        cut = (depth == 0) & x.isin(*SEPARATORS)
        return F.struct(
            depth.alias("depth"),
            F.when(cut, F.lit("")).otherwise(F.concat(s["now"], x)).alias("now"),
            F.when(cut, F.concat(s["done"], F.array(s["now"]))).otherwise(s["done"]).alias("done"),
        )

    def finish(s: Column) -> Column:
        trimmed = F.transform(F.concat(s["done"], F.array(s["now"])), lambda x: F.btrim(x, F.lit(TRIMMED)))
        return F.transform(F.filter(trimmed, lambda x: x != ""), lambda x: F.replace(x, F.lit("\ue000"), F.lit("/")))

    parts = F.aggregate(F.filter(F.split(masked, ""), lambda x: x != ""), zero, step, finish)
    flat = F.transform(F.split(masked, f"[{''.join(SEPARATORS)}]"), lambda x: F.btrim(x, F.lit(TRIMMED)))
    flat = F.transform(F.filter(flat, lambda x: x != ""), lambda x: F.replace(x, F.lit("\ue000"), F.lit("/")))
    # without an opening bracket every separator splits
    return F.when(masked.startswith("="), F.array(F.trim(c))).when(~masked.rlike(r"[(\[（]"), flat).otherwise(parts)


def ends_label(c: Column, rules: dict[str, str], default: str = "other") -> Column:
    """Label of the first suffix that a name ends with."""
    out = F.lit(default)
    for suffix, label in reversed(rules.items()):
        out = F.when(c.endswith(suffix), F.lit(label)).otherwise(out)
    return out


# Suffixes of institution names with their types and letters, a name with a type of its own, places of branches.
NAME_TYPES = {"지소": "branch", "구치소": "detention_center", "교도소": "prison"}
NAME_LETTERS = {"교도소": "교", "구치소": "구"}
OWN_TYPES, BRANCHES, BRANCH = {"소망교도소": "private_prison"}, ("평택", "서산", "논산"), "지소"


def name_type(name: Column) -> Column:
    """Type that an institution's name tells by its end."""
    out = ends_label(name, NAME_TYPES)
    for own, kind in OWN_TYPES.items():
        out = F.when(name == own, F.lit(kind)).otherwise(out)
    return out


def short_name(name: Column) -> Column:
    """A branch by its place; else the last word of the name becomes its letter."""
    out = name
    for suffix, letter in NAME_LETTERS.items():
        out = F.when(name.endswith(suffix), F.concat(F.regexp_replace(name, f"{suffix}$", ""), F.lit(letter))).otherwise(out)
    for place in reversed(BRANCHES):
        out = F.when(name.endswith(BRANCH) & name.contains(place), F.lit(place + BRANCH)).otherwise(out)
    return out


def name_aliases(name: Column, raw: Column, more: Column | None = None) -> Column:
    """Sorted names under which an institution is known."""
    ways = [name, raw, F.replace(name, F.lit(" "), F.lit(""))]
    for suffix, letter in NAME_LETTERS.items():
        base = F.regexp_replace(name, f"{suffix}$", "")
        ways += [F.when(name.endswith(suffix), F.concat(base, F.lit(x))) for x in (letter, f"({letter})")]
    found = F.array_compact(F.array(*ways))
    found = F.concat(found, F.coalesce(more, F.array().cast("array<string>"))) if more is not None else found
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: x != "")))


def contains_label(c: Column, rules: dict[str, tuple[str, ...]]) -> Column:
    """Label of the first rule with a word that the text contains; null if none."""
    out = F.lit(None).cast("string")
    for label, words in reversed(rules.items()):
        hit = F.lit(False)
        for w in words:
            hit = hit | c.contains(w)
        out = F.when(hit, F.lit(label)).otherwise(out)
    return out
