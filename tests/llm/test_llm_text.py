"""Words, lines, hashes and windows of a batch against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetpulse.llm.text import Batch, occurrence, windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet=" \t\nabé  x.", max_size=30)), max_size=6)


@settings(max_examples=80, deadline=None)
@given(texts)
def test_words_and_lines(rows):
    batch = Batch(pa.array(rows, pa.string()))
    data = batch.data.tobytes()
    for i, text in enumerate(rows):
        low, high = batch.word_bounds[i], batch.word_bounds[i + 1]
        found = [data[a:b].decode() for a, b in zip(batch.starts[low:high], batch.ends[low:high])]
        assert found == WORD.findall(text or "")
    starts, ends, line_rows, words = batch.lines()
    expected = [(i, line, len(WORD.findall(line))) for i, t in enumerate(rows) for line in (t or "").split("\n")]
    assert [(r, data[a:b].decode(), n) for r, a, b, n in zip(line_rows, starts, ends, words)] == expected


@settings(max_examples=50, deadline=None)
@given(texts)
def test_hashes_tell_words_apart_and_only_them(rows):
    batch = Batch(pa.array(rows, pa.string()))
    words = [w for t in rows for w in WORD.findall(t or "")]
    hashes = batch.word_hashes().tolist()
    assert len(set(zip(words, hashes))) == len(set(words)) == len(set(hashes))
    elsewhere = Batch(pa.array([" ".join(reversed(words))])).word_hashes().tolist()
    assert elsewhere == hashes[::-1]


def test_a_slice_of_an_array_is_itself():
    whole = pa.array(["a b", "c", None, "d e f"])
    part = Batch(whole.slice(1, 3))
    assert np.diff(part.word_bounds).tolist() == [1, 0, 3]
    assert part.word_hashes().tolist() == Batch(pa.array(["c d e f"])).word_hashes().tolist()


def test_windows_stay_in_their_text_and_occurrences_count():
    batch = Batch(pa.array(["a b a b a", "a b"]))
    grams, at = windows(batch.word_hashes(), batch.word_row, 2)
    assert at.tolist() == [0, 1, 2, 3, 5]
    assert grams[0] == grams[2] == grams[4] != grams[1]
    assert occurrence(grams, batch.word_row[at]).tolist() == [0, 0, 1, 1, 0]
    assert windows(batch.word_hashes(), batch.word_row, 9)[1].tolist() == []
