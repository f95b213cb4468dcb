"""What text must hold for a regular expression to match it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BREAK = "\x00"  # where a literal run ends
META = ".[]{}()*+?^$|"  # fixed value: characters that mean something unless escaped
_HELD = [chr(0xE010 + i) for i in range(len(META))]  # stand for the escaped ones
_BACKSLASH = "\ue001"
# Escapes that are not a literal character, with what belongs to them.
_CLASS_ESCAPES = r"\\(?:x\{[^}]*\}|x[0-9a-f]{2}|u[0-9a-f]{4}|[pn]\{[^}]*\}|p.|c.|k<[^>]*>|[0-9]+|[a-z])"
MOST_WAYS = 32


def literal_runs(regex: Column) -> Column:
    """``array<array<string>>``: ways a lower-case regex can match, each the literal runs that its matches hold; NULL if nothing is known.

    A text that the regex matches holds all runs of at least one way. Character classes, wildcards and optional
    parts end a run; a repeated part counts once; alternatives and groups are multiplied out, up to ``MOST_WAYS`` ways, beyond which a
    group counts as unknown text. A way without a run, look-around, flags, named groups and nested classes make the whole regex
    unknown (NULL): such a regex must be tried on every text.
    """
    brk = F.lit(BREAK)
    t = F.replace(regex, F.lit("\\\\"), F.lit(_BACKSLASH))
    t = F.regexp_replace(t, _CLASS_ESCAPES, BREAK)
    for meta, held in zip(META, _HELD, strict=True):
        t = F.replace(t, F.lit("\\" + meta), F.lit(held))
    t = F.regexp_replace(t, r"\\(.)", "$1")
    t = F.regexp_replace(t, r"\[\^?[^\[\]&]+\]", BREAK)
    t = F.replace(t, F.lit("(?:"), F.lit("("))
    unknown = regex.rlike(r"[\x00\x{E001}\x{E010}-\x{E01F}]") | t.rlike(r"[\[\]\\]|\(\?")
    depth = F.size(F.split(t, r"\(", -1)) - 1

    def open_group(ways: Column, _: Column) -> Column:
        """Each way with its last innermost group written out."""

        def one(way: Column) -> Column:
            part = lambda i: F.regexp_extract(way, r"(?s)^(.*)\(([^()]*)\)([*?+]?)(\{[^}]*\})?(.*)$", i)
            loose = part(3).isin("*", "?") | (part(4) != "")
            body = F.when(loose | (F.size(ways) * F.size(F.split(part(2), r"\|", -1)) > MOST_WAYS), F.array(brk)).otherwise(
                F.transform(F.split(part(2), r"\|", -1), lambda b: F.when(part(3) == "+", F.concat(brk, b, brk)).otherwise(b))
            )
            spelt = F.transform(body, lambda b: F.concat(part(1), b, part(5)))
            return F.when(way.rlike(r"\([^()]*\)"), spelt).otherwise(F.array(way))

        return F.flatten(F.transform(ways, one))

    ways = F.aggregate(F.sequence(F.lit(0), depth), F.array(t), open_group)
    ways = F.flatten(F.transform(ways, lambda w: F.split(w, r"\|", -1)))

    def runs(way: Column) -> Column:
        plain = F.regexp_replace(way, r"(?s).(?:[*?]|\{[^}]*\})[+?]?", BREAK)
        plain = F.regexp_replace(plain, r"(?s)(.)\+[+?]?", "$1" + BREAK)
        plain = F.regexp_replace(plain, r"[.^$]", BREAK)
        back = F.translate(plain, "".join(_HELD) + _BACKSLASH, META + "\\")
        return F.array_distinct(F.filter(F.split(back, BREAK, -1), lambda r: r != ""))

    found = F.transform(ways, runs)
    return F.when(~unknown & ~F.exists(found, lambda r: F.size(r) == 0), found)
