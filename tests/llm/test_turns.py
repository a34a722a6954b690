from __future__ import annotations

import time
from itertools import permutations

import numpy as np
import pandas as pd

from framewright.llm.turns import assign_labels, assignment_cost, attributed, norm_label, optimal_assignment, read_pieces, skeleton_keys, speaker_turns


def test_reading():
    assert [(x[0], x[3]) for x in read_pieces("[00:01:02] Young Master Ju (V.O.): Um, hello there. [thunder]")] == [("young master ju", True), ("thunder", False)]
    assert [(x[0], x[3]) for x in read_pieces("庹空青 : 呃，没有火车票。 — 【荀半夏】 表妹卖了。")] == [("庹空青", True), ("荀半夏", True)]
    assert [x[3] for x in read_pieces("00:12 (sighs) ♪ strings ♪")] in ([], [False])
    assert read_pieces("") == [] and not any(x[3] for x in read_pieces("嗯嗯， 呃。") + read_pieces("Uh, er...."))
    assert read_pieces(">> Yunqi:Kneel down")[0][:1] == ("yunqi",) and read_pieces("<v Xi_Yunqi>uh")[0][3] is False
    assert len(read_pieces("x" * 100_000)) == 1


def test_phonetics():
    assert assignment_cost("yan muzhii", "yan muzhi") == 1 and assignment_cost("muzhi yan", "yan muzhi") == 0
    for a, b in (("yantng", "yantang"), ("uqiu", "duqiu"), ("zhensshu", "zhenshu"), ("cn duqiu", "cen duqiu"), ("qii", "qi")):
        assert set(skeleton_keys(a)) & set(skeleton_keys(b)), (a, b)
    assert norm_label("[XI_YUNQI]") == "xi yunqi"


def test_turns(spark):
    words = [{"low_confidence": True}]
    rows = [
        ("d", "e", 1, "unnamed words", False, None), ("d", "e", 2, "Ann Lee: one", False, None), ("d", "e", 2, "Ann Lee: one", False, None), ("d", "e", 4, "[thunder]", False, None),
        ("d", "e", 5, "two", None, []), ("d", "e", 7, "Thanks for watching", True, words), ("d", "e", 9, "three. — BOB: four", False, None), ("d", "e", 5000, "Bobb -- five", True, None), ("d", "e", 5001, None, False, None),
        ("d", "f", 1, " ", False, None), (None, "h", 1, "Ann Lee: x", False, None),
    ]
    seg = spark.createDataFrame(rows, "g string, ep string, id int, text string, risky boolean, words array<struct<low_confidence:boolean>>")
    roster = spark.createDataFrame([("d", "A", "Ann Lee"), ("d", "B", "Bob"), ("d", "B", None)], "g string, canonical string, variant string")
    assert sorted(tuple(r) for r in speaker_turns(seg, roster).collect()) == [("e", 2, 9, "A"), ("e", 9, 5000, "B")]
    assert speaker_turns(seg.limit(0), roster).count() == 0


def test_assignment_is_optimal():
    rnd = np.random.default_rng(0)
    for _ in range(100):
        n, m = int(rnd.integers(1, 6)), int(rnd.integers(6, 8))
        cost = rnd.integers(0, 6, (n, m)).astype(float)
        got = optimal_assignment(cost)
        assert len(set(got)) == n
        assert cost[np.arange(n), got].sum() == min(sum(cost[i, p[i]] for i in range(n)) for p in permutations(range(m), n))
    parts = "ab cd ef gh ij kl mn"
    assert assignment_cost(" ".join(reversed(parts.split())), parts) == 0 and assignment_cost("lin", "lin xia") == 3


def test_labels_are_assigned_together():
    def settled(*rows):
        return assign_labels(pd.DataFrame(rows, columns=["label", "variant", "person", "cost"]))

    assert settled(("lana", "lena", "P", 1), ("lana", "lina", "Q", 1)) == {}  # a tie
    assert settled(("lena", "lena", "P", 0), ("lena", "lina", "Q", 1), ("lana", "lena", "P", 1), ("lana", "lina", "Q", 1)) == {"lena": "P", "lana": "Q"}
    assert settled(("bob", "bob", "B", 0), ("bobb", "bob", "B", 1), ("bop", "bob", "B", 1)) == {"bob": "B", "bobb": "B", "bop": "B"}


def test_long_names_and_marks():
    name = "Anna Berta Clara Dora Emma Frieda Gerda"
    assert [x[:3] for x in read_pieces(f"So we left. {name}: come")] == [("", False, "So we left."), (name.lower(), False, "come")]
    assert read_pieces(f"[{'x' * 500}] hi")[0][:2] == ("x" * 500, True) and read_pieces("Анна: да")[0][0] == "анна"
    assert [x[0] for x in read_pieces("Dr. Lin: hi. He went. Bo Xi: no")] == ["dr lin", "bo xi"]
    began = time.time()
    for t in ("a-", "a.", "a. ", "go on. ", "word ", "a:", "[", "[a", "词", ">>"):
        read_pieces(t * 20_000)
    assert time.time() - began < 20


def test_flagged_speech_stays_none_and_names_stay_in_words(spark):
    bad, good = [{"low_confidence": True}], [{"low_confidence": False}]
    rows = [("d", "e", 1, "Anna: hello", False, good), ("d", "e", 2, "Nobody: thanks for watching", True, bad), ("d", "e", 3, "Notaname: we must go", False, good), ("d", "e", 4, "[thunder] now", False, good)]
    seg = spark.createDataFrame(rows, "g string, ep string, id int, text string, risky boolean, words array<struct<low_confidence:boolean>>")
    roster = spark.createDataFrame([("d", "A", "Anna")], "g string, canonical string, variant string")
    got = sorted((r.id, r.speaker, r.words) for r in attributed(seg, roster).collect())
    assert got == [(1, "A", "hello"), (3, "A", "Notaname: we must go"), (4, "A", "now")]
