"""op8's samples: the elements that cannot be one are left out, and every sample is as by the plain formula."""

from __future__ import annotations

import numpy as np

from tidepool.llm import icws
from tidepool.llm.common import Words, by_text_and_hash, distinct, find, mix64


def plain(sample: icws.Sampler, text, element, weight, n_text):
    """The samples by the formula, text by text and over all its elements."""
    out = np.zeros((n_text, len(sample.seeds)), dtype=np.uint32)
    log_w = np.log(weight).astype(np.float32)
    for k, seed in enumerate(sample.seeds):
        with np.errstate(over="ignore"):
            u = (element ^ seed) * np.uint64(0xFF51AFD7ED558CCD)
            u ^= u >> np.uint64(32)
            u *= np.uint64(0xC4CEB9FE1A85EC53)
            u ^= u >> np.uint64(29)
        i, j = (u >> np.uint64(48)).astype(np.int64), (u >> np.uint64(32)).astype(np.int64) & 0xFFFF
        beta = u.astype(np.uint32).astype(np.float32) * np.float32(2.0**-32)
        t = np.floor(log_w * sample.inverse[i] + beta)
        value = (beta - t - np.float32(1)) * sample.r[i] + sample.log[j]
        for x in np.unique(text):
            own = np.flatnonzero(text == x)
            at = own[np.argmin(value[own])]
            code = mix64(element[at : at + 1] ^ mix64(t[at : at + 1].astype(np.int64).view(np.uint64)))
            out[x, k] = int(code[0] >> np.uint64(32)) | 1
    return out


def test_samples_are_those_of_the_formula_and_few_elements_are_looked_at(monkeypatch):
    rng = np.random.default_rng(7)
    sizes = [1, 0, 2, 5, 30, 400, 6000, 3]
    text = np.repeat(np.arange(len(sizes)), sizes)
    element = mix64(rng.integers(0, 1 << 62, len(text)).astype(np.uint64))
    weight = rng.uniform(1, 2, len(text)) * np.where(rng.random(len(text)) < 0.2, np.log(rng.integers(2, 300, len(text)) / (rng.integers(1, 2, len(text)))) / 50 + 1e-3, 1.0)
    sample = icws.Sampler()
    looked = []
    least = sample._least
    monkeypatch.setattr(sample, "_least", lambda u, *how: (looked.append(len(u)), least(u, *how))[1])
    assert np.array_equal(sample(text, element, weight, len(sizes)), plain(sample, text, element, weight, len(sizes)))
    assert 0 < sum(looked) < 0.1 * len(text) * len(sample.seeds)
    # a limit that no value is below: every text is looked at whole, and the samples stay
    monkeypatch.setattr(icws, "SURE", 1e-9)
    assert np.array_equal(sample(text, element, weight, len(sizes)), plain(sample, text, element, weight, len(sizes)))


def test_words_are_counted_once_a_text_and_found_in_a_table():
    texts = ["b a b\tc", "", "a  a\x1fa é", "c"]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    text, which, hashes = icws._words_by_text(Words(data, offsets))
    assert sorted(zip(text.tolist(), hashes[which].tolist())) == sorted({(t, h) for t, h in zip(Words(data, offsets).text.tolist(), Words(data, offsets).hash.tolist())})
    assert [int(n) for n in np.bincount(text, minlength=4)] == [3, 0, 3, 1]
    table = np.sort(hashes)[::2]
    assert find(table, hashes)[1].tolist() == np.isin(hashes, table).tolist()
    assert not find(table[:0], hashes)[1].any()
    # hashes that differ in their last bits only are still told apart and sorted
    t, h = np.array([0, 3, 3, 3, 3]), np.array([5, 9, 8, 9, 8], dtype=np.uint64)
    assert by_text_and_hash(t, h).tolist() == np.lexsort((h, t)).tolist()
    own, at = distinct(h)
    assert own[at].tolist() == h.tolist() and len(own) == 3
