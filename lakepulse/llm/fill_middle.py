"""Fill-in-middle samples: texts are cut at token bounds that are found from memoized summaries of content-defined chunks.

A token is a run of A-Z and a-z, or one other code point. A rolling hash cuts the bytes of a text into chunks, so that equal passages
give equal chunks wherever they stand. Each task keeps the summaries of the chunks it has seen, by content: how many tokens and code
points begin in a chunk, and whether it begins and ends with a letter. A letter that follows a letter begins no token, so summaries
add up to the counts of the text, and a cut is looked for in the one chunk that holds it.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import text as tx
from .common import ship, table

U = np.uint64
#: Bytes of a chunk, and of the window whose hash ends one; a window in 1024 does.
SHORTEST, LONGEST, WINDOW, ENDS = 256, 8192, 32, U(54)
#: Bytes of text that are hashed at once, and bytes of chunks that a task keeps of each of two generations.
AT_ONCE, KEPT = 1 << 20, 32 << 20
MARKS = ("<P>", "<S>", "<M>")

LETTER = np.zeros(256, bool)
LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
#: Bytes that begin a code point.
LEAD = (np.arange(256) & 0xC0) != 0x80


def _rolling(data: np.ndarray) -> np.ndarray:
    """The hash of the WINDOW bytes that end at each byte (fewer at the start), by doubling."""
    h, n = tx.BYTES[data], 1
    while n < WINDOW:
        longer = h.copy()
        longer[n:] += h[:-n] * tx.powers(tx.BYTE_BASE, n + 1)[n]
        h, n = longer, 2 * n
    return tx.mix(h)


def chunk_ends(data: np.ndarray) -> list[int]:
    """Where the chunks of a text end. The bounds depend on the bytes near them, and on the bound before."""
    found = []
    for at in range(0, len(data), AT_ONCE):
        before = min(at, WINDOW - 1)
        h = _rolling(data[at - before : at + AT_ONCE])[before:]
        found.append(np.flatnonzero(h >> ENDS == 0) + at + 1)
    ends, last = [], 0
    for end in [*np.concatenate(found).tolist(), len(data)] if found else []:
        while end - last > LONGEST:
            last += LONGEST
            ends.append(last)
        if end - last >= SHORTEST or (end == len(data) and end > last):
            ends.append(last := end)
    return ends


def _starts(chunk: np.ndarray, after_letter: bool) -> np.ndarray:
    """Where the tokens of a chunk begin."""
    letter = LETTER[chunk]
    follows = np.concatenate([[after_letter], letter[:-1]])
    return np.flatnonzero(LEAD[chunk] & ~(letter & follows))


class Summaries:
    """(tokens, code points, begins with a letter, ends with one) of chunks, as if nothing stood before them, by their content.

    A chunk is found by its bytes: those of equal hash are compared whole. Of the chunks seen the last KEPT bytes at least are held.
    """

    def __init__(self, kept: int = KEPT):
        self.kept, self.new, self.old, self.bytes, self.hits, self.misses = kept, {}, {}, 0, 0, 0

    def of(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        found = self.new.get(chunk)
        if found:
            self.hits += 1
            return found
        found = self.old.get(chunk)
        if found:
            self.hits += 1
        else:
            self.misses += 1
            data = np.frombuffer(chunk, np.uint8)
            found = len(_starts(data, False)), int(np.count_nonzero(LEAD[data])), bool(LETTER[data[0]]), bool(LETTER[data[-1]])
        if self.bytes > self.kept:
            self.old, self.new, self.bytes = self.new, {}, 0
        self.new[chunk] = found
        self.bytes += len(chunk)
        return found


class Chunked:
    """A text as chunks with the running counts of tokens and code points before each."""

    def __init__(self, text: str, summaries: Summaries):
        self.bytes = text.encode()
        self.ends = chunk_ends(np.frombuffer(self.bytes, np.uint8))
        self.tokens, self.chars, self.after = [0], [0], []
        start, letter = 0, False
        for end in self.ends:
            tokens, chars, begins, ends = summaries.of(self.bytes[start:end])
            self.after.append(letter)
            self.tokens.append(self.tokens[-1] + tokens - (letter and begins))
            self.chars.append(self.chars[-1] + chars)
            start, letter = end, ends

    @property
    def n(self) -> int:
        return self.tokens[-1]

    def cut(self, units: int) -> int:
        """Code points of the first so many tokens: the next one begins there."""
        if units >= self.n:
            return self.chars[-1]
        k = bisect_right(self.tokens, units) - 1
        chunk = np.frombuffer(self.bytes, np.uint8)[self.ends[k - 1] if k else 0 : self.ends[k]]
        at = _starts(chunk, self.after[k])[units - self.tokens[k]]
        return self.chars[k] + int(np.count_nonzero(LEAD[chunk[:at]]))


def draws(doc_id: int | None, seed: str) -> list[int]:
    """Four numbers of 32 bits, the first of the hex SHA-256 of seed:doc_id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def fill_in_middle(docs: DataFrame, seed: str = "1", changed: int = 90, spm: int = 20) -> DataFrame:
    """(row, n, form, prefix_chars, middle_chars, output) of each row of docs (doc_id, text, any others, all in the struct row).

    n is the number of tokens. The text is cut after two drawn numbers of tokens into prefix, middle and suffix; draws depend on seed
    and doc_id only, so rows of one id are drawn alike, and a null id counts as an empty one. form is plain if the text is empty or null,
    if it has one of MARKS, or by draw, for all but `changed` in 100; of the others, `spm` in 100 put the suffix first. Lengths are in
    code points and null where plain; output is the text as the form has it. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    counts = T.StructType.fromDDL("n long, form string, prefix_chars long, middle_chars long, output string")
    schema = T.StructType([T.StructField("row", docs.schema), *counts])

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, summaries = to_arrow_schema(schema), Summaries()
        for batch in batches:
            for part in tx.slices(batch, "text", 4 << 20):
                rows = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    text = text or ""
                    chunked = Chunked(text, summaries)
                    a, b, plain, order = draws(doc_id, seed)
                    if not text or any(m in text for m in MARKS) or plain % 100 >= changed:
                        rows.append((chunked.n, "plain", None, None, text))
                        continue
                    first, last = sorted((a % (chunked.n + 1), b % (chunked.n + 1)))
                    first, last = chunked.cut(first), chunked.cut(last)
                    prefix, middle, suffix = text[:first], text[first:last], text[last:]
                    p, s, m = MARKS
                    form, output = ("spm", f"{s}{suffix}{p}{prefix}{m}{middle}") if order % 100 < spm else ("psm", f"{p}{prefix}{s}{suffix}{m}{middle}")
                    rows.append((chunked.n, form, first, last - first, output))
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(out)[1:])]
                yield pa.RecordBatch.from_arrays([part.to_struct_array().cast(out.field("row").type), *columns], schema=out)

    return docs.mapInArrow(sample, schema)


def restored(form: Column, output: Column) -> Column:
    """The text that a sample was made of: in it no mark stands but those that the form puts there."""
    p, s, m = MARKS
    part = lambda k: F.get(F.split(output, f"{p}|{s}|{m}", -1), F.lit(k))
    return F.when(form == "psm", F.concat(part(1), part(3), part(2))).when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = restored(F.col("form"), F.col("output"))
    return found.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))
