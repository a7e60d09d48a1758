"""Fill-in-the-middle by an Aho-Corasick event scan (operator 13).

A text is cut after some number of units (lines, words or characters) into
prefix, middle and suffix, which are written in one of two orders behind three
sentinels.  One automaton over the sentinels and the ASCII characters that end a
unit scans each text once; what it finds are *events*.  The gaps between them
hold no border, or (characters) one after each character, so their units are
counted by arithmetic, and the code points before the k-th border are looked up
by rank among the events alone.

===== ====================================== =============================
unit  pattern                                events
===== ====================================== =============================
line  ``[^\\n]*\\n|[^\\n]+``                 new lines
word  ``[^\\s]*[\\s]+|[^\\s]+`` (ASCII)      white space; a run is one border
char  every code point                       none
===== ====================================== =============================

Cuts and orders follow from a hash of the id, so a lost task repeats them.

The order is ``plain`` (the text as it is) for an empty text, for one that
contains a sentinel, which the output could not tell from its own, and for the
share that ``rate`` leaves.  A part can't make a sentinel with one beside it, as
``<`` only begins one, so ``restored`` gives every text back.

Defined results: a null text is the empty one; very long texts are scanned whole;
repeated rows give repeated results; a null id hashes as the empty string; an
empty table gives an empty result; other columns play no role; ids may be of any
type.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import whole_text

PREFIX, SUFFIX, MIDDLE = SENTINELS = "<P>", "<S>", "<M>"
BORDERS = {"line": "\n", "word": " \t\n\x0b\x0c\r", "char": ""}
CHUNK = 1 << 23  # characters handed on at once


@lru_cache(maxsize=4)
def _automaton(unit: str):
    import ahocorasick

    found = ahocorasick.Automaton()
    for c in BORDERS[unit]:
        found.add_word(c, True)
    for s in SENTINELS:
        found.add_word(s, False)
    found.make_automaton()
    return found


def scan(text: str, unit: str) -> tuple[np.ndarray | None, int, bool]:
    """(code points before each border but the last unit's end, number of units, whether a sentinel occurs)."""
    borders, clear = [], True
    for at, border in _automaton(unit).iter(text):
        if border:
            borders.append(at + 1)
        else:
            clear = False
    if unit == "char":
        return None, len(text), not clear
    ends = np.array(borders, np.int64)
    if unit == "word":
        ends = ends[np.diff(ends, append=len(text) + 2) > 1]  # of a run, the last
    return ends, len(ends) + int(bool(text) and (not len(ends) or ends[-1] < len(text))), not clear


def before(text: str, ends: np.ndarray | None, units: int) -> int:
    """Code points in the first ``units`` units."""
    if ends is None or not units:
        return units
    return int(ends[units - 1]) if units <= len(ends) else len(text)


def transformed(doc_id, text: str, tag: str, unit: str, rate: int, spm: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    ends, n, marked = scan(text, unit)
    digest = hashlib.sha256(f"{tag}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    if not text or marked or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = before(text, ends, first), before(text, ends, second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, tag: str = "7", unit: str = "line", rate: int = 100, spm: int = 50) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output: one row per document.

    Of 100 texts ``rate`` are transformed, and of these ``spm`` with the suffix first.
    """
    if unit not in BORDERS:
        raise ValueError(f"unit must be one of {sorted(BORDERS)}")
    rows = docs.select("doc_id", whole_text("text").alias("text"))

    def run(batches):
        for batch in batches:
            ids, texts, start = batch.column(0), batch.column(1), 0
            while start < batch.num_rows:
                found, size, end = [], 0, start
                while end < batch.num_rows and (end == start or size < CHUNK):
                    found.append(transformed(ids[end].as_py(), texts[end].as_py(), tag, unit, rate, spm))
                    size += len(found[-1][-1])
                    end += 1
                types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
                columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([ids.slice(start, end - start), *columns], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
                start = end

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored() -> Column:
    """The text, from ``form`` and ``output`` alone."""
    part = F.split("output", "<[PSM]>", -1)
    return F.when(F.col("form") == "psm", F.concat(part[1], part[3], part[2])).when(F.col("form") == "spm", F.concat(part[2], part[3], part[1])).otherwise(F.col("output"))
