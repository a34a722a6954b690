from __future__ import annotations

import pickle
import random

import numpy as np
import pandas as pd

from framewright.llm.truncation import DIMS, NUMERIC, THRESHOLDS, WORD_BINS, best_threshold, cuts_of, features, find_truncated, gradient, prefix_bins, word_bin


def test_held_out_cuts(spark):
    rnd = random.Random(2)
    subj, verb, rest = ["The lawyer", "Her sister", "A stranger", "Nobody"], ["burned", "returned", "understood", "followed"], ["the letter in secret", "the bracelet before midnight", "everything for seventeen years", "the contract without a single apology"]
    rows, cut = [], set()
    for k in range(1200):
        t = " ".join(f"{rnd.choice(subj)} {rnd.choice(verb)} {rnd.choice(rest)}." for _ in range(rnd.choice([1, 2, 3])))
        if rnd.random() < 0.2:
            t = t[:-1]
        if k % 12 == 0 and len(t) > 60 and t[59].isalnum() and t[60].isalnum():
            t = t[:60]
            cut.add(k)
        rows.append((k, "s", t, "x"))
    rows += [(5000, None, None, "x"), (5001, "s", "", "x"), (None, "s", "no key", "x"), (5002, "s", "word " * 20_000, "x"), rows[0]]
    got = find_truncated(spark.createDataFrame(rows, "id long, src string, body string, field string"), "id", "src", ["body"]).collect()
    assert len(got) == 1201 and len({r.id for r in got}) == 1201
    found = {r.id for r in got if r.probability >= 0.5 and r.id < 5000}
    assert len(found & cut) >= 0.8 * len(cut) and len(found - cut) <= 0.03 * len(rows)


def test_empty(spark):
    assert find_truncated(spark.createDataFrame([], "id long, src string, body string"), "id", "src", ["body"]).count() == 0


def test_threshold_lies_where_unseen_values_are_rarest():
    rnd = np.random.default_rng(0)
    values = np.r_[rnd.beta(1, 30, 3000), rnd.beta(30, 1, 300), np.linspace(0.1, 0.42, 60), np.linspace(0.52, 0.9, 60)]
    assert 0.4 < best_threshold(values) < 0.52
    assert best_threshold(np.zeros(0)) == best_threshold(np.zeros(10)) == THRESHOLDS[0]


def test_beginnings_of_words_have_no_bound():
    (bins,) = prefix_bins(pd.Series(["é" + "x" * 999]))
    assert len(bins) == 999 and bins[0] == word_bin("é") and bins[40] == word_bin("é" + "x" * 40)
    assert prefix_bins(pd.Series(["a"])).tolist() == [[]]


def test_whole_values_are_read():
    counts = tuple(np.zeros(WORD_BINS, dtype=np.float32) for _ in range(3))
    open_early = "<a " + "x" * 200
    assert features(open_early, "f", (0.0, 0.0), counts) != features(open_early[3:], "f", (0.0, 0.0), counts)


def test_training_counts_every_value(spark):
    # 30,000 values are more than any former fitting sample; the totals of the first gradient are those of all of them.
    from framewright.llm import truncation

    seen = []
    whole = truncation.train

    def spy(blocks, fields):
        seen.extend(pickle.loads(b) for b in blocks.collect())
        return np.zeros((2, truncation.DIMS + truncation.NUMERIC * 2)), dict.fromkeys(fields, 2.0)

    rows = [(k, "s", f"Nobody expected the housekeeper {k % 7000} to understand contracts.") for k in range(30_000)]
    truncation.train = spy
    try:
        find_truncated(spark.createDataFrame(rows, "id long, src string, body string"), "id", "src", ["body"])
    finally:
        truncation.train = whole
    assert sum(b["weight"][b["y"] == 0].sum() for b in seen) == 30_000
    assert sum(b["weight"][b["y"] == 1].sum() for b in seen) >= 25_000


def test_nothing_to_cut_means_no_cuts(spark):
    rows = [(k, "s", "Now") for k in range(50)]
    assert find_truncated(spark.createDataFrame(rows, "id long, src string, body string"), "id", "src", ["body"]).filter("is_cut").count() == 0


def test_limits_of_other_sources_strike():
    counts = tuple(np.zeros(WORD_BINS, dtype=np.float32) for _ in range(3))
    pairs = (np.array([[9.0, 9.0]]), np.array([5]))
    got = cuts_of("Share all chapters without interruptions", 200, np.random.default_rng(1), (np.array([25]), pairs), (np.zeros((1, 2)), np.array([1])), counts)
    at = sum(n for c, r, n in got if len(c) in (23, 24, 25) and r == (9.0, 9.0))
    assert at >= 80 and sum(n for *_, n in got) >= 180


def test_common_clauses_teach_both_models_and_fields_have_own_weights():
    one = {"index": np.zeros((2, 1), np.int16), "numbers": np.ones((2, NUMERIC), np.float32), "weight": np.ones(2), "half": np.zeros(2, np.int8)}
    block = one | {"y": np.zeros(2, np.int8), "field": np.array([0, 1]), "keep": np.ones(2, bool), "common": np.array([True, False])}
    sums = gradient(block, np.zeros((2, DIMS + 3 * NUMERIC))).reshape(2, 2, -1)
    assert sums[0, 0, -1] == 1 and sums[1, 0, -1] == 2
    assert sums[0, 0, DIMS + NUMERIC : DIMS + 2 * NUMERIC].all() and not sums[0, 0, DIMS + 2 * NUMERIC : -1].any()
