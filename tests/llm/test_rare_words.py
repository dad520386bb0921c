"""Words that the table of document frequencies has no room for keep their exact weights."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidepool.llm import icws
from tidepool.llm.common import Words


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        words = rng.choices(vocabulary, [1 / (j + 1) for j in range(400)], k=rng.randint(3, 90))
        rows.append((3 * i, " ".join(words)))
        if i % 3 == 0:
            words[len(words) // 2] = f"own{i}"
            rows.append((3 * i + 1, " ".join(words)))
    rows += [(200, None), (201, ""), (202, rows[0][1]), (None, rows[1][1])]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_rare_words_bring_exact_frequencies(spark, texts):
    from pyspark.sql import functions as F

    rows = texts.select(F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), "text")
    held = [re.findall(r"[^ ]+", r.text or "") for r in rows.collect()]
    df, n = Counter(w for t in held for w in set(t)), len(held)
    table, rest = icws.word_frequencies(rows, "text", 20)
    assert table.floor > 1 and len(table.hashes) <= 20
    lists = icws.rare_words(rows, spark.sparkContext.broadcast(table), rest)
    joined = rows.join(lists, ["h1", "h2"]).select("text", "rare").toArrow().combine_chunks()
    assert joined.num_rows
    for i, text in enumerate(joined.column("text").to_pylist()):
        words = sorted(set(text.split(" ")))
        blob = " ".join(words).encode()
        hashes = Words(np.frombuffer(blob, np.uint8), np.array([0, len(blob)])).hash
        own = table.knowing(joined.column("rare").chunk(0).slice(i, 1)).of(hashes)
        assert np.allclose(own, [1 + math.log((1 + n) / (1 + df[w])) / math.log(1 + n) for w in words], atol=1e-6)


@pytest.mark.parametrize("most", [0, 20])
def test_classes_do_not_depend_on_the_table(texts, most):
    whole = sorted(map(tuple, icws.near_duplicates(texts).collect()), key=str)
    assert sorted(map(tuple, icws.near_duplicates(texts, table_words=most).collect()), key=str) == whole
    assert len({c for _, _, c in whole}) < len(whole) - 4


def test_texts_are_not_dealt_out_again_for_their_rare_words(spark, texts, monkeypatch):
    seen = []
    join = type(texts).join

    def watched(self, other, *how, **more):
        seen.append((set(self.columns), set(other.columns)))
        return join(self, other, *how, **more)

    monkeypatch.setattr(type(texts), "join", watched)
    icws.near_duplicates(texts, table_words=0)
    assert not [b for _, b in seen if {"text", "rare"} <= b]  # such a side is made anew, with a shuffle of all texts, where it is joined
    assert sum("text" in a and "rare" in b for a, b in seen) == 1
