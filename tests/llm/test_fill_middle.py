"""Fill-in-middle samples against a regular expression over whole texts."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakepulse.llm import fill_middle as fm

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")
SCHEMA = "doc_id long, text string, n long, output string, row string"


def texts():
    rng = np.random.default_rng(5)
    letters = list("abcXYZ  \n.é中🙂0")
    passage = "".join(rng.choice(letters, 20_000))
    drawn = ["".join(rng.choice(letters, k)) for k in (1, 2, 3, 17, 255, 256, 257, 5000)]
    return [None, "", " ", "word", "é", "🙂", "a" * 30_000, "中" * 9000, "\n" * 700, passage, "x" + passage, passage[500:], "has <S> inside", "<P", "<", "a<M><P>b", "Ab" * 9000 + "1" + "z" * 20_000, *drawn]


def want(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(tokens), "plain", None, None, text
    lo, hi = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    prefix, middle, suffix = "".join(tokens[:lo]), "".join(tokens[lo:hi]), "".join(tokens[hi:])
    form = "spm" if h[3] % 100 < 20 else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return len(tokens), form, len(prefix), len(middle), output


@pytest.fixture(scope="module")
def rows():
    every = texts()
    return [*((i * 3 + k, t, -1, "clash", "clash") for k in range(3) for i, t in enumerate(every)), (None, "null id of a row", 1, None, None), (4, "twice", 0, "", ""), (4, "twice", 0, "", "")]


def test_samples(spark, rows):
    got = fm.fill_in_middle(spark.createDataFrame(rows, SCHEMA)).withColumn("back", fm.restored(F.col("form"), F.col("output"))).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.row.doc_id, r.row.text, *r[1:6]) for r in got), key=key) == sorted(((r[0], r[1], *want(r[0], r[1])) for r in rows), key=key)
    assert all(r.back == (r.row.text or "") and (r.row.n, r.row.row) in ((-1, "clash"), (1, None), (0, "")) for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fm.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0


def test_chunks_of_shared_passages_are_known_again():
    rng = np.random.default_rng(6)
    passage, kept = "".join(rng.choice(list("abcd e.é"), 60_000)), fm.Summaries()
    first = fm.Chunked(passage, kept)
    misses = kept.misses
    second = fm.Chunked("some other start é " + passage + " end", kept)
    assert misses == len(first.ends) > 20 and kept.misses - misses <= 4 and kept.hits >= misses - 3
    assert second.n == len(TOKEN.findall("some other start é " + passage + " end"))
    sizes = np.diff([0, *first.ends])
    assert sizes.max() <= fm.LONGEST and sizes[:-1].min() >= fm.SHORTEST


def test_few_summaries_are_held():
    rng = np.random.default_rng(7)
    kept = fm.Summaries(kept=20_000)
    for _ in range(30):
        text = "".join(rng.choice(list("ab c"), 9000))
        assert fm.Chunked(text, kept).n == len(TOKEN.findall(text))
    assert sum(map(len, kept.new)) + sum(map(len, kept.old)) < 2 * (20_000 + fm.LONGEST)


def test_texts_longer_than_a_pass_of_the_hash(monkeypatch):
    text = "".join(np.random.default_rng(8).choice(list("ab c.é"), 50_000))
    whole = fm.chunk_ends(np.frombuffer(text.encode(), np.uint8))
    monkeypatch.setattr(fm, "AT_ONCE", 1000)
    assert fm.chunk_ends(np.frombuffer(text.encode(), np.uint8)) == whole


def test_query_over_all_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = {r.doc_id: tuple(r[1:]) for r in fm.op13_fill_in_middle(spark, sf).collect()}
    assert got == {d: (*(w := want(d, t))[:4], sha(w[4]), sha(t or "")) for d, t in docs}
