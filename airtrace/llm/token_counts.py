"""Token counts with the whole-token shortcut.

Byte-level BPE never merges across pre-tokens, and a blank that follows a
character other than white space always begins one.  Vocabulary strings that
encode alone as one token are found offline, by encoding each of them
(:attr:`Vocabulary.alone`); between such blanks a text's piece that is one
of them counts one token by a set lookup.  Only the pieces that are left
over are merged, joined into one text per document: each begins with a
blank after a character that is no white space, so leaving out the pieces
between them moves no boundary.

The rule holds where every piece follows a character other than white
space.  Texts with runs of white space that end in a blank, with special
strings, or with characters whose class is not settled
(:mod:`airtrace.llm.tokens`) are encoded whole by the library.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtrace.llm.common import whole_text
from airtrace.llm.tokens import Vocabulary, vocabulary, vocabulary_path

_RUN = re.compile(r"\s ")


def count_tokens(text: str, v: Vocabulary) -> int:
    """Number of tokens of one text."""
    if not v.settled(text) or _RUN.search(text) or any(s in text for s in v.special):
        return v.count(text)
    first, *pieces = text.split(" ")
    alone, marked = v.alone, v.alone_and_mark
    rest = [p for p in pieces if p not in alone]
    n = len(pieces) - len(rest)
    left = [p for p in rest if p not in marked]
    n += 2 * (len(rest) - len(left))
    left.insert(0, first)
    return n + len(v.fast.encode_ordinary(" ".join(left)))


def count_all(docs: DataFrame, *, text_col: str = "text", out: str = "n_tokens",
              path: str | None = None) -> DataFrame:
    """``docs`` with the column ``out`` (long): the tokens of each text.

    No begin, end or padding tokens, no truncation; strings of special
    tokens inside a text count as the library's default has it (one token).
    A null or empty text has 0.  Rows and other columns stay as they are,
    repeated rows included.  A column named ``out`` is replaced.
    """
    path = path or vocabulary_path()

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = vocabulary(path)
        for texts in batches:
            yield pa.array([count_tokens(t, v) for t in texts.to_pylist()], pa.int64())

    counter = F.arrow_udf(count, "long")
    return docs.withColumn(out, counter(whole_text(text_col)))
