"""Line-first quality rules: bad lines go first, then documents that lost too much.

Each line is judged alone: by its punctuation, as navigation, as boilerplate. Failing lines
are removed; a document that loses more than a share of its words to that is rejected, as
is one that fails the base rules (too few words, or mostly repeated ones).

Null and empty texts have no words and are rejected by the base rules. Texts are judged
whole at any length. Rows are independent: repeated rows get equal verdicts, an empty table
stays empty, other columns pass untouched.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.rows import SPACES, structs, texts, unused

SYMBOLS = b"#*$%&|<>"

#: Stock phrases of page furniture and licences, in lower case: English, German, French, Spanish.
BOILERPLATE = (
    "all rights reserved",
    "licensed under",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "accept cookies",
    "enable javascript",
    "subscribe to our newsletter",
    "lorem ipsum",
    "alle rechte vorbehalten",
    "nutzungsbedingungen",
    "datenschutzerklärung",
    "cookies akzeptieren",
    "javascript aktivieren",
    "newsletter abonnieren",
    "tous droits réservés",
    "conditions d'utilisation",
    "conditions d’utilisation",
    "politique de confidentialité",
    "mentions légales",
    "accepter les cookies",
    "activer javascript",
    "todos los derechos reservados",
    "términos de uso",
    "política de privacidad",
    "política de cookies",
    "aceptar cookies",
    "aviso legal",
)

_CONTINUATION = bytes(range(0x80, 0xC0))
_MARKED = re.compile(rb"[#*$%&!?]{2,}(?![^\x20\x09-\x0D])")
_SENTENCE_END = re.compile(rb"[.!?](?![^\x20\x09-\x0D])|\xe2\x80\xa6|\xe3\x80\x82")

#: Unicode's Sentence_Terminal characters beyond ASCII, the ellipsis and the Tibetan shads.
_TERMINALS = (
    "\u0589\u061d-\u061f\u06d4\u0700-\u0702\u07f9\u0837\u0839\u083d\u083e\u0964\u0965\u0f0d\u0f0e\u104a\u104b"
    "\u1362\u1367\u1368\u166e\u1735\u1736\u17d4\u17d5\u1803\u1809\u1944\u1945\u1aa8-\u1aab\u1b4e\u1b4f\u1b5a\u1b5b"
    "\u1b5e\u1b5f\u1b7d-\u1b7f\u1c3b\u1c3c\u1c7e\u1c7f\u2024\u2026\u203c\u203d\u2047-\u2049\u2cf9-\u2cfb\u2e2e\u2e3c"
    "\u2e53\u2e54\u3002\ua4ff\ua60e\ua60f\ua6f3\ua6f7\ua876\ua877\ua8ce\ua8cf\ua92f\ua9c8\ua9c9\uaa5d-\uaa5f"
    "\uaaf0\uaaf1\uabeb\ufe12\ufe15\ufe16\ufe52\ufe56\ufe57\uff01\uff0e\uff1f\uff61"
    "\U00010a56\U00010a57\U00010f55-\U00010f59\U00010f86-\U00010f89\U00011047\U00011048\U000110be-\U000110c1"
    "\U00011141-\U00011143\U000111c5\U000111c6\U000111cd\U000111de\U000111df\U00011238\U00011239\U0001123b\U0001123c"
    "\U000112a9\U000113d4\U000113d5\U0001144b\U0001144c\U000115c2\U000115c3\U000115c9-\U000115d7\U00011641\U00011642"
    "\U0001173c-\U0001173e\U00011944\U00011946\U00011a42\U00011a43\U00011a9b\U00011a9c\U00011c41\U00011c42"
    "\U00011ef7\U00011ef8\U00011f43\U00011f44\U00016a6e\U00016a6f\U00016af5\U00016b37\U00016b38\U00016b44"
    "\U00016d6e\U00016d6f\U00016e98\U0001bc9f\U0001da88"
)
#: What may stand between a sentence's mark and the space: closing quotes and brackets, quotes
#: that also close in some languages, emphasis, raised figures, daggers, invisible marks.
_CLOSING = "".join(
    c for c in map(chr, range(0x80, 0x10000)) if unicodedata.category(c) in ("Pe", "Pf", "Pi", "Cf")
) + "\"')]}*_`\xb2\xb3\xb9\u2070-\u2079\u2020\u2021\xa7\xb6"
_ANY_END = re.compile(
    rf"[{_TERMINALS}]|[.!?](?:[{re.escape(_CLOSING)}]"
    r"|\[[^\[\]]{1,40}\]|\(\d{1,3}\))*(?!\S)"
)
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)))
#: One separator between two labels, with blanks on both sides or on none.
_SEPARATOR = re.compile(r"(?<=\s)[|›»](?=\s)|(?<=\w)[|›»](?=\w)")


@dataclass(frozen=True)
class LineRules:
    """Thresholds; shares are of a line's words, or of a document's words for ``lost``.

    A longer line than ``boilerplate_words`` holds more than the stock phrase and stays. What
    the values rest on, without labels: ``min_words`` and ``lost`` are the least length and
    the greatest share of repeated lines of the published Gopher rules; most written sentences
    stay below 25 words, so a longer line is a paragraph that only mentions the phrase, and
    prose ends a sentence within 40. No labelled texts besides the check tables confirm them.
    """

    min_words: int = 50
    repeated: float = 0.5
    marked: float = 0.3
    separators: int = 3
    separated: float = 0.15
    unpunctuated: int = 40
    boilerplate_words: int = 25
    lost: float = 0.3


def has_sentence_end(line: bytes) -> bool:
    """Whether a sentence ends in the line, in any script that marks the ends of sentences."""
    return bool(_SENTENCE_END.search(line) or _ANY_END.search(line.decode("utf-8", "replace")))


def line_fails(line: bytes, n_words: int, rules: LineRules) -> str:
    """Name of the rule that a line with words fails, or an empty string."""
    marks = len(_MARKED.findall(line))
    if marks > rules.marked * n_words and marks > 1:
        return "punctuation"
    if n_words >= rules.unpunctuated and not has_sentence_end(line):
        return "punctuation"
    if is_navigation(line, n_words, rules):
        return "navigation"
    if n_words <= rules.boilerplate_words and _BOILERPLATE.search(line.decode("utf-8", "replace").lower()):
        return "boilerplate"
    return ""


def is_navigation(line: bytes, n_words: int, rules: LineRules) -> bool:
    """Whether the line is labels with separators between them.

    A table row, framed by bars, is none; neither are bars that hug what they
    enclose, and marks of quotes that the line also opens.
    """
    least = max(rules.separators, int(rules.separated * n_words) + 1)
    if line.count(b"|") + line.count("›".encode()) + line.count("»".encode()) < least:
        return False
    text = line.decode("utf-8", "replace").strip()
    if text.startswith("|") and text.endswith("|"):
        return False
    found = _SEPARATOR.findall(text)
    quotes = sum(found.count(shut) for open_, shut in ("«»", "‹›") if open_ in text)
    return len(found) - quotes >= least


def repeated_words(words: list[bytes]) -> int:
    """Words inside a three-word window that occurs at least twice, its first time included."""
    n = len(words)
    if n < 4:
        return 0
    vocabulary: dict[bytes, int] = {}
    ids = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int64)
    pairs = ids[:-1] * len(vocabulary) + ids[1:]
    if len(vocabulary) >= 1 << 20:  # else three ids fit in 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    windows = pairs[:-1] * len(vocabulary) + ids[2:]
    order = np.argsort(windows)
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.r_[same, False] | np.r_[False, same]
    covered = np.zeros(n + 1, np.int64)
    starts = order[twice]
    covered[starts] += 1
    np.subtract.at(covered, starts + 3, 1)
    return int((np.cumsum(covered)[:n] > 0).sum())


FIELDS = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "base_failed": pa.bool_(),
    "kept": pa.bool_(),
    "n_lost_words": pa.int64(),
    "cleaned": pa.string(),
}


def judge(text: bytes, rules: LineRules, with_text: bool) -> tuple:
    """The values of ``FIELDS`` for one text."""
    words = text.split()
    n_words = len(words)
    seen: set[bytes] = set()
    n_lines = lost = 0
    keep = []
    for line in text.split(b"\n"):
        size = len(line.split())
        if size:
            n_lines += 1
            seen.add(line)
            if line_fails(line, size, rules):
                lost += size
                continue
        keep.append(line)
    n_repeat = repeated_words(words)
    base_failed = n_words < rules.min_words or n_repeat > rules.repeated * n_words
    return (
        n_words,
        len(text.translate(None, SPACES + _CONTINUATION)),
        len(text) - len(text.translate(None, SYMBOLS)),
        n_lines - len(seen),
        n_repeat,
        base_failed,
        not base_failed and lost <= rules.lost * n_words,
        lost,
        b"\n".join(keep).decode("utf-8", "replace") if with_text else None,
    )


def line_quality(rules: LineRules = LineRules(), with_text: bool = False) -> Column:
    """Function of a text column: a struct of ``FIELDS``; ``cleaned`` is null unless asked for."""

    @F.arrow_udf(
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " base_failed boolean, kept boolean, n_lost_words long, cleaned string"
    )
    def quality(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in batches:
            found = list(zip(*(judge(t, rules, with_text) for t in texts(array)), strict=True))
            yield structs(dict(zip(FIELDS, found or [()] * len(FIELDS), strict=True)), FIELDS)

    return quality


def quality_report(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """``doc_id`` with the statistics and the verdict of each document."""
    judged = docs.select("doc_id", line_quality(rules)("text").alias("judged"))
    return judged.select("doc_id", *[f"judged.{name}" for name in FIELDS if name != "cleaned"])


def clean_documents(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The kept documents without their failing lines; ``n_chars``, if there, follows the text."""
    name = unused(docs, "judged")
    judged = docs.withColumn(name, line_quality(rules, with_text=True)("text"))
    kept = judged.filter(F.col(f"{name}.kept")).withColumn("text", F.col(f"{name}.cleaned"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.drop(name)
