"""Text to terms: Unicode word segmentation (UAX #29) and emoji (UTS #51), lower-cased.

The whole token list of a text is one built-in expression, so it runs inside
the scan stage. All repetitions are possessive: a match never backtracks and
needs no stack, however long a run of letters and digits in the text is.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

MAX_TOKEN = 255

# Characters that join two letters, two digits, or either, by the
# Word_Break property of the Unicode standard.
MID_LETTER = r":\u00b7\u0387\u055f\u05f4\u2027\ufe13\ufe55\uff1a"
MID_NUMBER = (
    r",;\u037e\u0589\u060c\u060d\u066c\u07f8\u2044"
    r"\ufe10\ufe14\ufe50\ufe54\uff0c\uff1b"
)
MID_EITHER = r".'\u2018\u2019\u2024\ufe52\uff07\uff0e"

# Scripts written without spaces, as ranges of a character class.
SPACELESS = (
    r"\u0e00-\u0eff"  # Thai, Lao
    r"\u1000-\u109f\ua9e0-\ua9ff\uaa60-\uaa7f"  # Myanmar
    r"\u1780-\u17ff\u19e0-\u19ff"  # Khmer
    r"\u1950-\u19df\u1a20-\u1aaf"  # Tai Le, New Tai Lue, Tai Tham
)
KATAKANA = r"\u3031-\u3035\u309b\u309c\u30a0-\u30fa\u30fc-\u30ff\u31f0-\u31ff\uff66-\uff9f"
SINGLES = (
    r"\u3041-\u3096\u309d-\u309f"  # Hiragana
    r"\u3005-\u3007\u3021-\u3029\u3038-\u303b\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
    r"\x{20000}-\x{3ffff}"  # Han
)

# Code points of the Unicode property Emoji that are an emoji by themselves.
EMOJI = (
    "203c 2049 2139 2194-2199 21a9-21aa 231a-231b 2328 23cf 23e9-23f3 23f8-23fa 24c2 25aa-25ab 25b6 25c0 "
    "25fb-25fe 2600-2604 260e 2611 2614-2615 2618 261d 2620 2622-2623 2626 262a 262e-262f 2638-263a 2640 2642 "
    "2648-2653 265f-2660 2663 2665-2666 2668 267b 267e-267f 2692-2697 2699 269b-269c 26a0-26a1 26a7 26aa-26ab "
    "26b0-26b1 26bd-26be 26c4-26c5 26c8 26ce-26cf 26d1 26d3-26d4 26e9-26ea 26f0-26f5 26f7-26fa 26fd 2702 2705 "
    "2708-270d 270f 2712 2714 2716 271d 2721 2728 2733-2734 2744 2747 274c 274e 2753-2755 2757 2763-2764 "
    "2795-2797 27a1 27b0 27bf 2934-2935 2b05-2b07 2b1b-2b1c 2b50 2b55 3297 3299 1f004 1f0cf 1f170-1f171 "
    "1f17e-1f17f 1f18e 1f191-1f19a 1f201-1f202 1f21a 1f22f 1f232-1f23a 1f250-1f251 1f300-1f321 1f324-1f393 "
    "1f396-1f397 1f399-1f39b 1f39e-1f3f0 1f3f3-1f3f5 1f3f7-1f3fa 1f400-1f4fd 1f4ff-1f53d 1f549-1f54e 1f550-1f567 "
    "1f56f-1f570 1f573-1f57a 1f587 1f58a-1f58d 1f590 1f595-1f596 1f5a4-1f5a5 1f5a8 1f5b1-1f5b2 1f5bc 1f5c2-1f5c4 "
    "1f5d1-1f5d3 1f5dc-1f5de 1f5e1 1f5e3 1f5e8 1f5ef 1f5f3 1f5fa-1f64f 1f680-1f6c5 1f6cb-1f6d2 1f6d5-1f6d9 "
    "1f6dc-1f6e5 1f6e9 1f6eb-1f6ec 1f6f0 1f6f3-1f6fc 1f7e0-1f7eb 1f7f0 1f90c-1f93a 1f93c-1f945 1f947-1f9ff "
    "1fa70-1fa7c 1fa80-1fac6 1fac8 1facc-1fadd 1fadf-1faeb 1faef-1fafa "
)
# Those that are one only with a variation selector behind them, and flag letters and skin tones.
EMOJI_IF_MARKED = r"\u00a9\u00ae\u2122\u3030\u303d\x{1f3fb}-\x{1f3ff}"
FLAG_LETTERS = r"\x{1f1e6}-\x{1f1ff}"
SKIN_TONES = r"\x{1f3fb}-\x{1f3ff}"

# Lower-case Latin letters below U+0100. Most text is made of these, so they are
# listed first and the slower tests of Unicode properties start at U+0100.
_LATIN = r"a-zªµºß-öø-ÿ"
_LETTER = (
    rf"[{_LATIN}[Ā-\x{{10ffff}}&&\p{{IsAlphabetic}}"
    rf"&&[^\p{{M}}{SPACELESS}{KATAKANA}{SINGLES}]]]"
)
_JOINER = r"[_[Ā-\x{10ffff}&&\p{Pc}]]"
_EXTEND = r"[­[̀-\x{10ffff}&&[\p{M}\p{Cf}]&&[^​]]]"

_LETTERS = rf"(?>{_LETTER}++(?>{_EXTEND}++)?+)++"
_DIGITS = rf"(?>\p{{Nd}}++(?>{_EXTEND}++)?+)++"
# A double quote between two Hebrew letters joins them, and an apostrophe behind one belongs to it.
_HEBREW = r"[\p{IsHebrew}&&\p{L}]"
_HEBREW_QUOTE = rf'"(?<={_HEBREW}{_EXTEND}{{0,9}}"){_EXTEND}*+(?={_HEBREW})'
_HEBREW_END = rf"(?>'(?<={_HEBREW}{_EXTEND}{{0,9}}'){_EXTEND}*+)?+"
_WORD = rf"{_LETTERS}(?>(?>[{MID_LETTER}{MID_EITHER}]{_EXTEND}*+|{_HEBREW_QUOTE}){_LETTERS})*+"
_NUMBER = rf"{_DIGITS}(?>[{MID_NUMBER}{MID_EITHER}]{_EXTEND}*+{_DIGITS})*+"
_JOINERS = rf"(?>{_JOINER}{_EXTEND}*+)"

# The plain case, tried first: Latin letters up to a character that ends a word.
_PLAIN = rf"[{_LATIN}]++(?=[.:']?+[\s,;!?()\"-])"
_MIXED = rf"{_JOINERS}*+(?>{_WORD}|{_NUMBER})(?>{_JOINERS}++|{_WORD}|{_NUMBER})*+{_HEBREW_END}"

_PICTURE = "[" + re.sub(r"([0-9a-f]+)", r"\\x{\1}", EMOJI).replace(" ", "") + "]"
_PICTURE_TAIL = rf"(?>[{SKIN_TONES}]|{_EXTEND}|(?<=\u200d)(?>{_PICTURE}|[{EMOJI_IF_MARKED}]))*+"
_EMOJI = (
    rf"(?>{_PICTURE}(?!\ufe0e){_PICTURE_TAIL}"
    rf"|[{FLAG_LETTERS}]{_EXTEND}*+[{FLAG_LETTERS}]{_EXTEND}*+"
    rf"|[{EMOJI_IF_MARKED}](?=\ufe0f){_PICTURE_TAIL}"
    rf"|[#*]\ufe0f?+\u20e3{_EXTEND}*+)"
)
_OTHER_SCRIPT = (
    rf"(?=[฀-\x{{10ffff}}])(?>"
    rf"(?>[{KATAKANA}]{_EXTEND}*+)++"
    rf"|[{SINGLES}]{_EXTEND}*+"
    rf"|(?>[{SPACELESS}&&[\p{{L}}\p{{M}}]]++{_EXTEND}*+)++"
    rf"|{_EMOJI})"
)
_MAY_START = rf"(?=[{_LATIN}0-9_Ā-\x{{10ffff}}])"
TOKEN_PATTERN = rf"(?>{_MAY_START}(?>{_PLAIN}|{_MIXED}|{_OTHER_SCRIPT})|(?=[#*\u00a9\u00ae]){_EMOJI})"


def lowered(text: Column) -> Column:
    """Lower case letter by letter: no final sigma, one letter for dotted I."""
    plain = F.replace(F.replace(text, F.lit("\u03a3"), F.lit("\u03c3")), F.lit("\u0130"), F.lit("i"))
    return F.lower(plain)


def tokens(text: Column) -> Column:
    """Array of the terms of a text in order, of any length."""
    return F.regexp_extract_all(lowered(text), F.lit(TOKEN_PATTERN), F.lit(0))


def cut_long(found: Column) -> Column:
    """``found`` with terms over 255 characters in pieces; give it a plain column."""
    pieces = F.flatten(
        F.transform(
            found,
            lambda t: F.regexp_extract_all(t, F.lit(rf"(?s).{{1,{MAX_TOKEN}}}"), F.lit(0)),
        )
    )
    return F.when(F.exists(found, lambda t: F.length(t) > MAX_TOKEN), pieces).otherwise(found)
