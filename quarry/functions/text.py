"""Scalar functions of a line, all as built-in expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BOM, ZWSP, NBSP, SHY = "﻿", "​", " ", "­"
_STRIPPED = {"bom": BOM, "zero_width_space": ZWSP}
#: Below U+0300 there are no combining marks, so such text is composed already.
_MAY_COMPOSE = "[^\\x{0}-\\x{2FF}]"
ARABIC = "[\\x{FB50}-\\x{FDFF}\\x{FE70}-\\x{FEFF}]"
_ICU = "com.ibm.icu.text.Normalizer"


def composed(text: Column, compatible: bool = False) -> Column:
    """NFC, or NFKC, by the library that Spark ships; it leaves whole-stage codegen, so guard it."""
    return F.reflect(F.lit(_ICU), F.lit("compose"), text, F.lit(compatible))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def beyond_ascii(text: Column) -> Column:
    """Whether a text has any character beyond ASCII; no pattern is run for it."""
    return F.octet_length(text) != F.char_length(text)


def fold_arabic(text: Column) -> Column:
    """Arabic presentation forms in their compatible form, all other characters as they are."""
    folded = F.concat_ws("", F.transform(F.split(text, ""), lambda c: F.when(c.rlike(ARABIC), composed(c, True)).otherwise(c)))
    return F.when(text.rlike(ARABIC), folded).otherwise(text)


def canonical(text: Column, strip: tuple[str, ...] = ("bom", "zero_width_space"), nbsp: bool = True, arabic: bool = True) -> Column:
    """A line with artifacts mapped character by character, and composed; ASCII lines are left alone.

    Stripping comes first, so U+FEFF never counts as an Arabic form.  A soft hyphen
    at the very end of the original line becomes a hyphen, any other goes.
    """
    out = F.when(text.endswith(SHY), F.concat(F.substring(text, F.lit(1), F.char_length(text) - 1), F.lit("-"))).otherwise(text)
    gone = SHY + "".join(_STRIPPED[s] for s in strip)
    out = F.translate(out, (NBSP if nbsp else "") + gone, " " if nbsp else "")
    compose = lambda x: F.when(x.rlike(_MAY_COMPOSE), composed(x)).otherwise(x)
    done = bound(out, lambda x: F.when(x.rlike(ARABIC), bound(fold_arabic(x), compose)).otherwise(compose(x)) if arabic else compose(x))
    return F.when(beyond_ascii(text), done).otherwise(text)


def needs_mapping(text: Column) -> Column:
    """Whether any character would be mapped, before composition."""
    return beyond_ascii(text) & (text.rlike(f"[{BOM}{ZWSP}{NBSP}{SHY}]") | text.rlike(ARABIC))


def domain(text: Column) -> Column:
    return F.when(text.rlike("[\\\\∑∫√≤≥]"), "math").otherwise("text")


def length_bin(text: Column) -> Column:
    n = F.length(text)
    return F.when(n <= 40, "short").when(n <= 240, "normal").otherwise("long")


#: Scripts whose letters are counted by a pattern each.
COMMON_SCRIPTS = "arabic armenian bengali cyrillic devanagari ethiopic georgian greek gujarati gurmukhi han hangul hebrew hiragana kannada katakana khmer lao latin malayalam myanmar sinhala tamil telugu thai tibetan".split()
_RARE = "[\\p{IsAlphabetic}&&[^\\p{IsCommon}\\p{IsInherited}\\p{IsUnknown}" + "".join(f"\\p{{Is{s.title()}}}" for s in COMMON_SCRIPTS) + "]]"


def _script_by_letter(text: Column) -> Column:
    """Looks each letter up; for texts with letters of rare scripts."""
    letters = F.filter(F.split(text, ""), lambda c: c.rlike("\\p{IsAlphabetic}"))
    scripts = F.filter(F.transform(letters, lambda c: F.lower(F.reflect(F.lit("java.lang.Character$UnicodeScript"), F.lit("of"), F.ascii(c)))), lambda s: ~s.isin("common", "inherited", "unknown"))
    return bound(scripts, lambda all_: F.array_min(F.transform(F.array_distinct(all_), lambda s: F.struct((-F.size(F.filter(all_, lambda x: x == s))).alias("n"), s.alias("script"))))["script"])


def dominant_script(text: Column) -> Column:
    """The script of most letters, in lower case; of equals the first by name; ``unknown`` without letters of a script."""
    counts = F.array(*[F.struct((-F.regexp_count(text, F.lit(f"[\\p{{IsAlphabetic}}&&\\p{{Is{s.title()}}}]"))).alias("n"), F.lit(s).alias("script")) for s in COMMON_SCRIPTS])
    common = bound(F.array_min(counts), lambda best: F.when(best["n"] < 0, best["script"]))
    best = F.coalesce(F.when(text.rlike(_RARE), _script_by_letter(text)).otherwise(common), F.lit("unknown"))
    # Letters below U+0250 are all Latin, so most lines never reach the counting.
    plain = F.when(text.rlike("[A-Za-z\\x{AA}\\x{BA}\\x{C0}-\\x{D6}\\x{D8}-\\x{F6}\\x{F8}-\\x{24F}]"), "latin").otherwise("unknown")
    return F.when(beyond_ascii(text) & text.rlike("[^\\x{0}-\\x{24F}]"), best).otherwise(plain)


def _codes(table: str) -> list[str]:
    return [head + tail for entry in table.split() for head, tails in [entry.split(":")] for tail in tails]


#: ISO 639-1, by first letter, and the longer codes that paths use.
LANGUAGES = _codes("a:abefkmnrsvyz b:aeghimnors c:aehorsuvy d:aevz e:elnostu f:afijory g:adlnuv h:aeiortuyz i:adegikostu j:av k:agijklmnorsuvwy l:abginotuv m:ghiklnrsty n:abdeglnorvy o:cjmrs p:alist q:u r:mnouw s:acdegiklmnoqrstuvw t:aeghiklnorstwy u:gkrz v:eio w:ao x:h y:io z:ahu") + "zho spa rus por kor jpn hin fra fas eng deu ben ara".split()


def path_tokens(path: Column) -> Column:
    """Runs of ASCII letters and digits of a path, in lower case."""
    return F.transform(F.filter(F.split(path, "[^0-9A-Za-z]+"), lambda t: t != ""), F.lower)


def language_hint(tokens: Column) -> Column:
    found = F.filter(tokens, lambda t: t.isin(LANGUAGES))
    return F.coalesce(F.try_element_at(found, F.lit(1)), F.lit("unknown"))


def source_group(tokens: Column) -> Column:
    found = F.filter(tokens, lambda t: ~t.isin(LANGUAGES) & (F.length(t) >= 3))
    return F.coalesce(F.try_element_at(found, F.lit(1)), F.lit("unknown"))


def slug(text: Column) -> Column:
    """ASCII letters and digits in lower case, runs of anything else as one ``_``, none at the ends."""
    out = F.lower(F.regexp_replace(F.regexp_replace(text, "[^0-9A-Za-z]+", "_"), "^_|_$", ""))
    return F.when(out == "", "unknown").otherwise(out)


def relative_path(path: Column, root: Column | str) -> Column:
    """The path below ``root``, or its last component where it isn't below it."""
    root = F.lit(root) if isinstance(root, str) else root
    prefix = F.concat(F.rtrim(root, F.lit("/")), F.lit("/"))
    return F.when(path.startswith(prefix), F.substring(path, F.length(prefix) + 1, F.length(path))).otherwise(F.element_at(F.split(path, "/"), -1))
