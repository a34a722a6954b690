from __future__ import annotations

import numpy as np
import pandas as pd

from framewright.llm import gru, language
from framewright.llm.language import judge, label_documents, letter_bytes, paragraphs, script_of_groups, short_evidence, windows
from framewright.llm.queries import p6_found, p6_languages


def test_gradients():
    rnd = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in gru.init(4, 3).items()}
    x, y = gru.pack([b"hello", b"abc", b"zzzzzzz"]), np.array([0, 1, 2])
    grads = gru.loss_and_grads(x, y, p)[1]
    for k in p:
        for _ in range(5):
            at = tuple(int(rnd.integers(0, n)) for n in p[k].shape)
            if k[0] == "E":
                at = (int(rnd.choice([104, 101, 97, 122])), at[1])
            was = p[k][at]
            p[k][at] = was + 1e-3
            up = gru.loss_and_grads(x, y, p)[0]
            p[k][at] = was - 1e-3
            down = gru.loss_and_grads(x, y, p)[0]
            p[k][at] = was
            assert abs((up - down) / 2e-3 - grads[k][at]) < 1e-3 * max(1, abs(grads[k][at])), (k, at)


def test_inference_equals_training_pass():
    p = gru.init(6, 3)
    ws = [b"a", b"hello world", b"abc", b"z" * 40]
    x = gru.pack(ws)
    q = gru.position_logits(x, p)
    q -= np.log(np.exp(q).sum(axis=2, keepdims=True))
    q[x == gru.PAD] = 0
    assert np.allclose(q.sum(axis=0), gru.window_scores(ws, p, block=2), atol=1e-3)


def test_parts():
    assert paragraphs("\n\n a\r\n\r\nb\n \t\nc\n") == ["a", "b", "c"] and paragraphs(" \n") == []
    assert b"".join(windows("x" * 1000)) == b"x" * 1000
    assert judge(np.zeros((2, 3)))[0] == -1


def texts(n, seed):
    rnd = np.random.default_rng(seed)
    bank = {
        "en": ["the house is near the river", "she went home with the children", "why are you waiting outside", "nothing was found in the garden"],
        "es": ["la casa está cerca del río", "ella volvió con los niños", "por qué esperas fuera del jardín", "no encontraron nada en la calle"],
        "de": ["das Haus liegt nahe am Fluss", "sie ging mit den Kindern nach Hause", "warum wartest du vor der Tür", "im Garten wurde nichts gefunden"],
        "zh": ["这座房子在河边", "她和孩子们回家了", "你为什么在外面等", "花园里什么都没有找到"],
    }
    out = []
    for k in range(n):
        lang = list(bank)[k % 4]
        out.append((lang, ". ".join(rnd.choice(bank[lang], 4)) + "."))
    return out


def test_held_out(spark):
    data = texts(400, 1)
    rows = [(k, t, lang if k % 10 else (None, "", "und", "es")[k // 10 % 4], "x") for k, (lang, t) in enumerate(data)]
    rows += [(900, data[0][1] * 3 + "\n\n" + data[1][1] * 3, "en", "x"), (901, None, "en", "x"), (902, " \n ", None, "x"), (903, "12:30 --- 77", "en", "x"), (904, data[2][1] * 2000, None, "x"), (None, "no key here", "en", "x"), rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, k string")
    got, net = label_documents(df, "doc_id", "text", "lang", languages=("en", "es", "de", "zh"))
    got = {(r.doc_id, r.para_no): r for r in got.collect()}
    right = sum(got[k, 0].found_lang == lang for k, (lang, _) in enumerate(data))
    assert right >= 0.97 * len(data)
    assert [got[900, i].found_lang for i in (1, 2)] == ["en", "es"] and got[900, 0].mixed
    assert all(got[k, 0].found_lang is None and got[k, 0].confidence == 0 for k in (901, 902, 903)) and got[904, 0].found_lang == "de"
    speech = spark.createDataFrame([("a", data[0][1]), ("a", None), ("b", data[3][1]), ("b", "ok"), (None, "x")], "ep_id string, text string")
    said = {r.ep_id: r.script for r in script_of_groups(speech, "ep_id", "text", net, languages=("en", "es", "de", "zh")).collect()}
    assert said == {"a": "latin", "b": "cjk"}
    assert label_documents(df.limit(0), "doc_id", "text", "lang")[0].count() == 0


def test_query_shape(spark, sf_dir):
    assert p6_found(spark, sf_dir).columns == ["rec_kind", "rec_id", "para_no", "found_lang"]


def test_short_paragraphs_speak():
    parts = ["Pourquoi le majordome attend-il toujours devant le temple ? Qui a caché le contrat dans le salon ?", "He fell down. It was so sad. She ran to the car.", "这也太上头了吧", "LOL ツ"]
    sizes, short = [letter_bytes(x) for x in parts], [short_evidence(x) for x in parts]
    assert max(sizes[1:]) < language.MIXED_BYTES and [han for _, han in short] == [False, False, True, False]
    fr, en, zh = np.array([0.0, -900, -900]), np.array([-240.0, 0, -300]), np.array([-60.0, -60, 0])
    each = lambda *s: [c for c, _ in judge(np.array(s), [sizes[i] for i in at], [short[i] for i in at])[3]]
    at = [0, 1]
    assert each(fr, en) == [0, 1] and each(fr, en / 4) == [0, 0]
    at = [0, 2]
    assert each(fr, zh) == [0, 2]
    at = [0, 3]
    assert each(fr, zh) == [0, 0]


def test_no_language_is_lost(monkeypatch):
    rounds = []
    monkeypatch.setattr(gru, "train", lambda xs, ys, *a: rounds.append(set(map(int, ys))) or gru.init(2, 3))
    monkeypatch.setattr(language, "score_texts", lambda docs, net: [np.array([[0.0, -1, -1]])] * len(docs))
    data = pd.DataFrame([(k, t, lang) for k, (lang, t) in enumerate(texts(60, 2))], columns=["k", "text", "lang"])
    language.train_network(data, ("en", "es", "de"))
    assert rounds == [{0, 1, 2}, {0, 1, 2}]


def test_script_of_every_episode(spark, sf_dir):
    got = p6_languages(spark, sf_dir).filter("rec_kind = 'episode'").collect()
    want = {r.ep_id for t in ("asr_segment", "episode_result") for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").select("ep_id").distinct().collect()} - {None}
    assert len(got) == len(want) and {r.ep_id for r in got} == want and {r.found_lang for r in got} <= {"cjk", "latin", None}


def test_a_network_gone_astray_is_not_chosen():
    data = texts(240, 3)
    held = pd.DataFrame([(k, t.replace(". ", ".\n\n"), lang) for k, (lang, t) in enumerate(data)], columns=["k", "text", "lang"])
    names = ("en", "es", "de", "zh")

    def fake(astray):
        return {"o": np.zeros(4), "astray": astray}

    def scored(docs, net):
        out = []
        for parts in docs:
            s = np.zeros((len(parts), 4))
            for i, p in enumerate(parts):
                lang = next(n for n, (x, t) in enumerate((n, t) for n, t in bank.items()) if p.strip(". ") in t)
                s[i] = -300
                s[i, (lang + 1) % 4 if net["astray"] and "river" in p else lang] = 0
            out.append(s)
        return out

    bank = {lang: " ".join(t for x, t in data if x == lang) for lang in names}
    was, language.score_texts = language.score_texts, scored
    try:
        got = language.choose_network([fake(True), fake(False), fake(False)], held, names)
        alone = language.choose_network([fake(True)], held, names)
    finally:
        language.score_texts = was
    assert not got["astray"] and got["off"][0] > 0 == got["off"][1] and got["wrong"].min() == 0
    assert alone["off"].tolist() == [0]


def test_unseen_phrases(spark):
    """Whole phrases left out of the labelled documents are still read right, mostly."""
    data = texts(400, 7)
    unseen = ("waiting outside", "esperas fuera", "wartest du", "外面等")
    seen = [(k, t, lang) for k, (lang, t) in enumerate(data) if not any(u in t for u in unseen)]
    rest = [(1000 + k, t, None) for k, (lang, t) in enumerate(data) if any(u in t for u in unseen)]
    df = spark.createDataFrame(seen + rest, "doc_id long, text string, lang string")
    got, net = label_documents(df, "doc_id", "text", "lang", languages=("en", "es", "de", "zh"))
    assert {"strict", "off", "wrong"} <= set(net) and len(net["off"]) == language.CANDIDATES
    said = {r.doc_id: r.found_lang for r in got.filter("para_no = 0").collect()}
    assert sum(said[1000 + k] == lang for k, (lang, t) in enumerate(data) if 1000 + k in said) >= 0.9 * len(rest)


def test_window_scores_without_the_largest_and_with_it():
    # Scores of large output weights take the largest score away first; both ways give log probabilities of the positions.
    for scale in (1.0, 400.0):
        p = gru.init(6, 3)
        p["W"] *= np.float32(scale)
        ws = [b"hello", b"some longer words", b"z"]
        x = gru.pack(ws)
        q = gru.position_logits(x, p).astype(np.float64)
        q -= q.max(axis=2, keepdims=True)
        q -= np.log(np.exp(q).sum(axis=2, keepdims=True))
        q[x == gru.PAD] = 0
        assert np.allclose(gru.window_scores(ws, p), q.sum(axis=0), rtol=1e-4, atol=1e-3)
