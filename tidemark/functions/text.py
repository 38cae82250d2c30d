"""Text, UUID, digest and rendering functions over columns."""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Device names that no partition value may take.
RESERVED = ("con", "prn", "aux", "nul", *(f"com{i}" for i in range(1, 10)), *(f"lpt{i}" for i in range(1, 10)))


@lru_cache(maxsize=1)
def _foldings() -> tuple[str, str, dict[str, str]]:
    """What compatibility decomposition leaves in ASCII of each other character of all planes, where it leaves anything.

    Characters that become one letter, those letters, and what the rest become.
    """
    found = {}
    for n in (*range(0x80, 0xD800), *range(0xE000, 0x110000)):
        if unicodedata.decomposition(chr(n)):
            plain = unicodedata.normalize("NFKD", chr(n)).encode("ascii", "ignore").decode()
            if plain:
                found[chr(n)] = plain
    one = {k: v for k, v in found.items() if len(v) == 1}
    return "".join(one), "".join(one.values()), {k: v for k, v in found.items() if len(v) > 1}


def strip(c: Column) -> Column:
    """Without leading and trailing white space (blanks, tabs and the breaks of lines and pages)."""
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))


def folded(c: Column) -> Column:
    """ASCII letters of a text after compatibility decomposition: accents go, ligatures come apart, other characters vanish.

    Letters are translated one by one; the table of characters that come apart is looked at only in texts that have one.
    """
    letters, plain, parts = _foldings()
    table = F.from_json(F.lit(json.dumps(parts)), "map<string,string>")
    apart = F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(table[x], x)), "")
    opened = F.when(c.rlike(f"[{''.join(parts)}]"), apart).otherwise(c)
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.regexp_replace(F.translate(opened, letters, plain), r"[^\x00-\x7F]+", "")).otherwise(c)


def slug(c: Column) -> Column:
    """A value as a safe partition folder: ASCII letters, digits, `-` and `_`, lower case, never a reserved name. A value that leaves nothing is an error."""
    x = F.lower(F.regexp_replace(F.regexp_replace(folded(c), "[^A-Za-z0-9_-]+", "-"), "^[-_]+|[-_]+$", ""))
    return F.when(x == "", F.raise_error(F.concat(F.lit("no safe folder name in: "), c)).cast("string")).when(x.isin(*RESERVED), F.concat(F.lit("_"), x)).otherwise(x)


def canonical_uuid(c: Column) -> Column:
    """Lower-case hyphenated form of any spelling of a UUID (braces, urn, no hyphens); null if it is none."""
    x = F.lower(strip(c))
    x = F.when(x.startswith("urn:uuid:"), F.substring(x, 10, 1_000_000)).otherwise(x)
    for sign in "{}-":
        x = F.replace(x, F.lit(sign), F.lit(""))
    parts = (F.substring(x, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return F.when((F.octet_length(x) == 32) & F.unhex(x).isNotNull(), F.concat_ws("-", *parts))


def iso(c: Column) -> Column:
    """A timestamp in ISO 8601 with its UTC offset and microseconds if there are any. The session's zone must be UTC."""
    return F.when(F.unix_micros(c) % 1_000_000 == 0, F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))


def joined(c: Column) -> Column:
    """An array of strings as one string."""
    return F.array_join(c, ",")


def finite(c: Column) -> Column:
    return ~(F.isnan(c) | (F.abs(c) == float("inf")))


def name_uuid(namespace: str, name: Column) -> Column:
    """The version-5 UUID of a name in a namespace (a UUID as text)."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    part = lambda a, n: F.substring(digest, a, n)
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))
