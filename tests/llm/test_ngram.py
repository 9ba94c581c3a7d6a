from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import BLANK_WORD, CAPITALS

from snapstrata.llm import elias_fano, ngram_lm
from snapstrata.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
END, BEGIN = "\n", "\n\n"


def tokens(text):
    return [*BLANK_WORD.findall((text or "").translate(CAPITALS)), END]


class PlainModel:
    """The same formulas on dictionaries, with one discount per level."""

    def __init__(self, texts, order=3):
        self.counts = [Counter() for _ in range(order)]
        for text in texts:
            own = tokens(text)
            for k, word in enumerate(own):
                self.counts[0][(word,)] += 1
                before = [BEGIN, *own[:k]]
                for n in range(1, order):
                    if n <= len(before):
                        self.counts[n][(*before[-n:], word)] += 1
        self.n, self.v = sum(self.counts[0].values()), len(self.counts[0])
        self.context = [None] + [Counter() for _ in range(order - 1)]
        self.types = [None] + [Counter() for _ in range(order - 1)]
        self.discount = [None]
        for n in range(1, order):
            for gram, c in self.counts[n].items():
                self.context[n][gram[:-1]] += c
                self.types[n][gram[:-1]] += 1
            once, twice = (sum(c == k for c in self.counts[n].values()) for k in (1, 2))
            self.discount.append(min(0.95, max(0.1, once / max(1, once + 2 * twice))))

    def base(self, word):
        return (self.counts[0][(word,)] + 0.5) / (self.n + 0.5 * (self.v + 1))

    def probability(self, before, word):
        p = self.base(word)
        for n in range(1, len(self.counts)):
            context = tuple(before[-n:])
            total = self.context[n][context] if len(context) == n else 0
            if not total:
                continue
            c, d = self.counts[n][(*context, word)], self.discount[n]
            p = max(c - d, 0) / total + d * self.types[n][context] / total * p
        return p

    def score(self, text):
        own = tokens(text)
        return sum(math.log10(self.probability([BEGIN, *own[:k]], w)) for k, w in enumerate(own))


def texts_of(n, seed=0):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.8))}" for _ in range(80)]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_one_shard_equals_the_plain_model(spark, order):
    learned = texts_of(120) + [None, "", "Mixed CASE mixed"]
    asked = texts_of(30, seed=1) + ["never seen words", "", None, "w1", learned[3]]
    frame = spark.createDataFrame([(t,) for t in learned], "text string")
    model = ngram_lm.train(frame, order=order, shards=1)
    plain = PlainModel(learned, order)
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(asked)], "doc_id long, text string, score string")
    for r in ngram_lm.score_texts(docs, model, keep=["doc_id"]).collect():
        own = tokens(asked[r.doc_id])
        assert (r.n_tokens, r.train_tokens) == (len(own), plain.n)
        assert r.n_known == sum(plain.counts[0][(w,)] > 0 for w in own)
        assert math.isclose(r.base_score, sum(math.log10(plain.base(w)) for w in own), rel_tol=1e-9)
        # probabilities are quantised to steps of 0.0002 of their logarithm
        assert abs(r.score - plain.score(asked[r.doc_id])) < 0.0005 * len(own)


def test_shards_and_split_contexts_agree_with_one_shard(spark):
    # one word is the context of most bigrams, so that it is split between shards
    rng = random.Random(9)
    learned = [" ".join(f"hot v{rng.randrange(400)}" for _ in range(20)) for _ in range(60)] + texts_of(60)
    frame = spark.createDataFrame([(t,) for t in learned], "text string").repartition(4)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(learned + texts_of(20, 5))], "doc_id long, text string")
    one = ngram_lm.train(frame, shards=1)
    many = ngram_lm.train(frame, shards=16)
    assert many.levels[0].left and len(many.levels[0].files) > 8
    assert [level.size for level in one.levels] == [level.size for level in many.levels]
    a, b = ({r.doc_id: r for r in ngram_lm.score_texts(docs, m).collect()} for m in (one, many))
    for k, r in a.items():
        assert (r.n_known, r.train_tokens) == (b[k].n_known, b[k].train_tokens)
        # one discount a level, whatever the shards
        assert abs(r.score - b[k].score) < 0.0005 * r.n_tokens


def test_probabilities_of_a_context_add_up(spark):
    learned = texts_of(80)
    model = ngram_lm.train(spark.createDataFrame([(t,) for t in learned], "text string").repartition(3), shards=8)
    reader = ngram_lm.Reader(model)
    vocabulary = sorted({w for t in learned for w in tokens(t)[:-1]})
    every = [ngram_lm.xxh3_64_intdigest(w) for w in vocabulary] + [ngram_lm.END_HASH]
    number, count = reader.numbers(np.array(every, dtype=np.uint64))
    base = (count + 0.5) / (model.tokens + 0.5 * (model.vocabulary + 1))
    for context in [*number[:10].tolist(), model.begin]:
        _, kept, left = reader.look_up(0, np.full(len(number), context), number)
        assert abs((kept + left * base).sum() + left[0] * 0.5 / (model.tokens + 0.5 * (model.vocabulary + 1)) - 1) < 0.01


def test_query_learns_from_the_other_folds(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op7_ngram_trie_scores"](spark, SF).collect()
    assert len(rows) == len(docs)
    counts = Counter(w for k, t in docs.items() if zlib.crc32(str(k).encode()) % 5 != 1 for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    better = 0
    for r in rows:
        own = tokens(docs[r.doc_id])
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own), rel_tol=1e-9)
        better += r.score > r.base_score
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    model = ngram_lm.train(empty)
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in ngram_lm.score_texts(docs, model).collect()}
    assert (got[1].n_tokens, got[1].n_known, got[1].train_tokens) == (3, 0, 0)
    assert got[1].score == got[1].base_score
    assert ngram_lm.score_texts(empty, model).count() == 0


@pytest.mark.parametrize("n, universe", [(0, 0), (1, 0), (5, 3), (1000, 10), (1000, 10**9), (70_000, 10**6), (3, 2**40)])
def test_elias_fano(n, universe, tmp_path):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe + 1, n))
    path = str(tmp_path / "arrays.bin")
    elias_fano.write_arrays(path, elias_fano.nested("x", elias_fano.encode(values, universe)))
    sequence = elias_fano.EliasFano(elias_fano.within("x", elias_fano.map_arrays(path)))
    assert (sequence.access(np.arange(n)) == values).all()
    asked = np.concatenate([values, rng.integers(0, universe + 50, 300)])
    first = rng.integers(0, n + 1, len(asked))
    place = np.maximum(np.searchsorted(values, asked), first)
    found = sequence.find(asked, first, np.full(len(asked), n))
    inside = place < n
    hit = np.zeros(len(asked), dtype=bool)
    hit[inside] = values[place[inside]] == asked[inside]
    assert (found == np.where(hit, place, -1)).all()
