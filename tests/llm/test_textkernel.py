import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from blattwerk.llm import textkernel as K


@pytest.mark.parametrize(("read", "right"), [("Septernber", "September"), ("v0n", "von"), ("Ab1auf", "Ablauf"), ("Wieclergabe", "Wiedergabe"), ("Zusfimmung", "Zustimmung"), ("Lernvverk", "Lernwerk"), ("qegen", "gegen")])
def test_misread_words_share_a_skeleton(read, right):
    assert K.skeleton(read) == K.skeleton(right)
    assert K.word_hash(read) == K.word_hash(right) != 0


def test_numbers_are_equal_and_single_letters_nothing():
    assert {K.word_hash(x) for x in ("12", "l4", "2O", "545a")} == {int(K.NUMBER)}
    assert K.word_hash("x") == 0


def test_lines_and_blocks_of_tokens():
    t = K.tokens(["eins zwei\ndrei", "", "\nvier"], join_hyphens=False)
    assert t.n_lines == 5
    assert t.line_block.tolist() == [0, 0, 1, 2, 2]
    assert t.line.tolist() == [0, 0, 1, 4]
    assert t.block.tolist() == [0, 0, 0, 2]
    assert K.line_starts(t).tolist() == [0, 2, 3]


def test_parted_words_are_joined_but_not_before_conjunctions():
    one = K.tokens(["Geneh-\nmigung", "Kauf-\nund Werkrecht"], join_hyphens=True)
    assert K.word_hash("Genehmigung") in one.h.tolist()
    assert K.word_hash("Kauf") in one.h.tolist()


def test_line_keys_ignore_case_space_numbers_and_single_letters():
    t = K.tokens(["Seite 4 von der Mitte\nSEITE  17 von der Mitte.\nvon der Mitte Seite 4\n"], join_hyphens=False)
    k = K.line_keys(t)
    assert k[0] == k[1] != k[2]
    assert k[3] == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aeiou bcd\n1", max_size=30), min_size=1, max_size=6))
def test_tokens_of_a_batch_are_those_of_its_texts(texts):
    t = K.tokens(texts, join_hyphens=False)
    for i, x in enumerate(texts):
        one = K.tokens([x], join_hyphens=False)
        assert np.array_equal(t.h[t.block == i], one.h)
    assert sum(b - a for a, b in K.slices(texts, 10)) == len(texts)
