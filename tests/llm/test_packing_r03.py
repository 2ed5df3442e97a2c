"""Packing: ids of texts whose letters change length or compose, and all cuts of the programme."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from orebridge.llm import packing
from orebridge.llm.queries import vocabulary

# Letters whose small form, composition or neighbours are unusual, with stops and marks.
TRICKY = st.text(st.sampled_from("İIıiŞşĞğÇç.,!?'’-_ \n\tabcABC019ßŒœŽžÅåéÉé̇İŉſKK漢ΣσςДд") | st.characters(codec="utf-8"),
                 max_size=40)


@settings(deadline=None, max_examples=600)
@given(st.lists(TRICKY, min_size=1, max_size=4))
def test_ids_of_tricky_texts(texts):
    enc = packing.encoder(vocabulary())
    for t in texts + [" ".join(texts)]:
        assert enc.ids([t])[0].tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["YENİ. SERGİSİ, x", "İ.", "Ali İ, b", "İ,İ.", "ẋ. y", "ŉ. a", "İstanbul'da. Çok, ŞİŞLİ."])
def test_ids_of_the_dotted_capital_i(text):
    enc = packing.encoder(vocabulary())
    for t in (text, text.lower(), f"plain words, {text} and more.", text * 3):
        assert enc.ids([t])[0].tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids


def test_every_power_of_two_and_every_sentence_end_may_end_a_window():
    """Brute force over all cuts on a small capacity."""
    rng = random.Random(3)
    for _ in range(40):
        total, cap = rng.randrange(5, 60), 16
        ends = np.array(sorted(rng.sample(range(1, total), k=min(3, total - 1)) + [total]))
        sentences = np.array(sorted(rng.sample(range(1, total), k=min(8, total - 1))))
        at, pen = packing.possible_cuts(ends, sentences, total, cap)
        assert set(sentences) <= set(at.tolist()) and set(ends) <= set(at.tolist())

        def cost(a, b):
            n = b - a
            return 0 if n & (n - 1) == 0 else cap - n
        best = {0: 0.0}
        for p, q in zip(at.tolist(), pen.tolist()):
            best[p] = min(v + cost(o, p) for o, v in best.items() if p - o <= cap) + q + packing.PER_SEQUENCE
        cuts, spent, begin = packing.best_cuts(at, pen, cap), 0.0, 0
        price = dict(zip(at.tolist(), pen.tolist()))
        for c in cuts:
            spent += cost(begin, c) + price[c] + packing.PER_SEQUENCE
            begin = c
        assert spent == best[total]
