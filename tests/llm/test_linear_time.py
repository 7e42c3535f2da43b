"""Work that grows with a text's length, not with its square."""

import time

import numpy as np
import pyarrow as pa
import pytest

from skywave.llm import chunk_dedup, html_extraction
from .conftest import prose


def seconds(f, *a):
    began = time.process_time()
    f(*a)
    return time.process_time() - began


@pytest.mark.parametrize("part", ["<a b ", '<a "', "<p title='x ", "<![CDATA[ x ", "<!-- x ", "<! ", "<p>text", "</div>", "a > b < c "])
def test_pages_of_unclosed_tags(part):
    """A page four times as long takes about four times as long (twelve at most)."""
    for end in ("", ">"):
        short, long = (part * (n // len(part)) + end for n in (250_000, 1_000_000))
        a, b = seconds(html_extraction.Page, short), seconds(html_extraction.Page, long)
        assert b <= 12 * max(a, 0.02), (part, end, a, b)


def test_unclosed_markup():
    text = lambda t: [b[1] for b in html_extraction.Page(t).blocks]
    assert text("<p>one</p><p>two <!-- gone") == ["one", "two"]
    assert text("<p>one</p><!-- gone <p>gone</p>") == ["one"]
    assert text("<p>one</p><p>two <b>three") == ["one", "two three"]
    assert text('<p title="a > b < c">one</p>') == ["one"]


def test_merged_chunks():
    """Runs of touching chunks, kept from RUN bytes on, for documents with any number of them."""
    rng = np.random.Generator(np.random.PCG64(1))
    docs = []
    for _ in range(200):
        at, c = 0, []
        for _ in range(rng.integers(1, 40)):
            at += int(rng.choice([0, 0, 0, 7]))
            c.append({"start": at, "end": at + int(rng.integers(16, 90))})
            at = c[-1]["end"]
        docs.append(c)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array([0] * 200, pa.int64()), pa.array(docs, kind)], ["doc", "crc", "c"])
    assert list(chunk_dedup._merged([batch.slice(0, 0)])) == []
    for b in (batch, batch.slice(50, 60)):
        rows = list(chunk_dedup._merged([b]))[0].to_pylist()
        for r, c in zip(rows, b.column("c").to_pylist(), strict=True):
            runs = []
            for x in c:
                if runs and runs[-1]["end"] == x["start"]:
                    runs[-1]["end"] = x["end"]
                else:
                    runs.append(dict(x))
            assert r["ranges"] == [x for x in runs if x["end"] - x["start"] >= chunk_dedup.RUN] and r["n_repeated"] == len(c)


def test_many_chunks_of_one_document():
    many = [{"start": 40 * i, "end": 40 * i + (40 if i % 9 else 39)} for i in range(400_000)]
    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([0], pa.int64()),
                                        pa.array([many], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], ["doc", "crc", "c"])
    assert seconds(lambda: list(chunk_dedup._merged([batch]))) < 2


def test_words_of_any_length_are_hashed_alike():
    from skywave.llm import kernel as K
    words = [b"a", b"A", b"abcdefgh", b"abcdefghi", b"ABCDEFGHI", b"x" * 64, b"x" * 65, b"X" * 65, "\u00e4\u00f6".encode(), b"abcdefg", b"abcdefg\0"]
    buf = np.frombuffer(b" ".join(words), np.uint8)
    h = K.words(buf, np.array([0, len(buf)]), K.NOT_SPACE)[0]
    assert h[0] == h[1] and h[3] == h[4] and h[6] == h[7] and len(set(h.tolist())) == len(words) - 3
    assert prose(1, 3)
