from __future__ import annotations

from framewright.llm.lookalike import canonical_value, look_value, same_look_pairs

SAME = [("ｆｕｌｌ width", "full width"), ("café", "café"), ("a​b", "ab"), ("a b", "a b"), ("a　b", "a b"), ("Nаdіe", "Nadie"), ("ﬁn", "fin"), ("⼈口", "人口"), ("你好，", "你好,")]
DIFFERENT = [("Abc", "abc"), ("x²", "x2"), ("②", "2"), ("resume", "résumé"), ("♪ a", "a"), ("<i>a</i>", "a"), ("a.", "a")]


def test_values():
    for a, b in SAME:
        assert look_value(a) == look_value(b) and canonical_value(a) == canonical_value(b), (a, b)
    for a, b in DIFFERENT:
        assert look_value(a) != look_value(b), (a, b)
    assert canonical_value("STRASSE") == canonical_value("straße") and canonical_value(" ​ ") == ""


def test_pairs_brute_force(spark):
    texts = ["abc", "аbc", "a​bc", "abd", None, "", "abc"]
    rows = [(f"e{k % 2}", k, (k * 977) % 9000, texts[k % len(texts)], "x") for k in range(80)]
    df = spark.createDataFrame(rows + rows[:9] + [("e0", 99, None, "abc", "x")], "ep_id string, id int, t int, raw string, g string")
    got = sorted(tuple(r) for r in same_look_pairs(df, "ep_id", "id", "t", "raw", 1500, chunk=3).collect())
    want = sorted((a[0], a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1] and a[3] and b[3] and a[3] != b[3] and look_value(a[3]) == look_value(b[3]) and abs(a[2] - b[2]) <= 1500)
    assert got == want and got
    assert same_look_pairs(df.limit(0), "ep_id", "id", "t", "raw", 1500).count() == 0
