import numpy as np
import pyarrow as pa
import pytest

from thermaspark.llm import toxicity
from thermaspark.llm.common import utf8
from thermaspark.llm.pieces import range_hashes


def weights():
    rng = np.random.default_rng(3)
    w = toxicity.new_weights(rng, np.zeros(0, np.uint64), np.ones(1 << toxicity.CHAR_BITS, bool))
    w["char"] = rng.standard_normal(w["char"].shape).astype(np.float32)
    return w | {"scale": np.array([5.0]), "shift": np.zeros(1)}


@pytest.mark.parametrize("bits", [6, 7, 9])
def test_texts_with_more_words_than_the_table_holds(monkeypatch, bits):
    texts = [" ".join(f"w{i}" for i in range(2000)), "", "one two", None, " ".join(f"v{i * i}" for i in range(700)) + " w5 w6", "w1 " * 60]
    raw, offsets = utf8(pa.array(texts, pa.string()))
    whole = toxicity.Scorer(weights()).scores(raw, offsets)
    monkeypatch.setattr(toxicity, "TABLE_BITS", bits)
    scorer = toxicity.Scorer(weights())
    for _ in range(2):
        assert np.allclose(scorer.scores(raw, offsets), whole, atol=1e-5)
    # the worst window by hand
    words = texts[0].split()
    own = [" ".join(words[i : i + toxicity.WINDOW]) for i in [*range(0, 2000 - toxicity.WINDOW, toxicity.STRIDE), 2000 - toxicity.WINDOW]]
    alone = toxicity.Scorer(weights()).scores(*utf8(pa.array(own, pa.string())))
    assert abs(whole[0] - alone.max()) < 1e-5 and len(set(alone.round(4))) > 10


@pytest.mark.parametrize("most", [30, 100, 1000])
def test_scores_are_the_same_however_few_words_are_run_at_once(monkeypatch, most):
    texts = ["", " ".join(f"w{i}" for i in range(500)), "one", " \t ", None, "w1 " * 90, "ends with éé words"]
    raw, offsets = utf8(pa.array(texts, pa.string()))
    whole = toxicity.Scorer(weights()).scores(raw, offsets)
    monkeypatch.setattr(toxicity, "RUN_WORDS", most)
    assert np.allclose(toxicity.Scorer(weights()).scores(raw, offsets), whole, atol=1e-5)
    for i, text in enumerate(texts):  # each alone, as first and as only text of a batch
        assert np.allclose(toxicity.Scorer(weights()).scores(*utf8(pa.array([text], pa.string()))), whole[i], atol=1e-5)
    assert len(toxicity.Scorer(weights()).scores(*utf8(pa.array([], pa.string())))) == 0


def plain_logit(window: list[str], w: dict) -> float:
    """One window, word by word, straight from the weights."""
    H, d = toxicity.HIDDEN, {int(k): i + 1 for i, k in enumerate(w["words"])}
    logistic = lambda x: 1 / (1 + np.exp(-x))
    lower = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    x = []
    for word in window:
        raw = word.encode().translate(lower)
        marked = [256, *raw, 257]
        rows = [((((marked[i - 1] * 263 + marked[i]) * 263 + marked[i + 1]) * 0x9E3779B1) >> 7) % (1 << toxicity.CHAR_BITS) for i in range(1, len(marked) - 1)]
        name = int(range_hashes(np.frombuffer(raw, np.uint8), np.array([0]), np.array([len(raw)]))[0])
        x.append(np.concatenate([w["word"][d.get(name, 0)].astype(float), np.mean([w["char"][r].astype(float) for r in rows], axis=0)]))

    def side(xs, W, U, c):
        h, out = np.zeros(H), []
        for v in xs:
            p = v @ W + c
            z, r = logistic(p[:H] + h @ U[:, :H]), logistic(p[H : 2 * H] + h @ U[:, H : 2 * H])
            n = np.tanh(p[2 * H :] + (r * h) @ U[:, 2 * H :])
            h = (1 - z) * n + z * h
            out.append(h)
        return out

    both = [np.concatenate(p) for p in zip(side(x, w["Wf"], w["Uf"], w["cf"]), side(x[::-1], w["Wb"], w["Ub"], w["cb"])[::-1], strict=True)]
    e = np.array([np.tanh(h @ w["A"]) @ w["v"] for h in both])
    a = np.exp(e - e.max()) / np.exp(e - e.max()).sum()
    return float(sum(p * (h @ w["u"]) for p, h in zip(a, both, strict=True)) + w["o"][0])


@pytest.mark.parametrize("scale,shift", [(5.0, 0.0), (0.7, -1.3)])
def test_scores_equal_a_plain_network(scale, shift):
    rng = np.random.default_rng(11)
    known = ["w1", "w2", "bad", "schön", "x" * 30]
    hashes = np.array([range_hashes(np.frombuffer(k.encode(), np.uint8), np.array([0]), np.array([len(k.encode())]))[0] for k in known])
    w = toxicity.new_weights(rng, np.sort(hashes), np.ones(1 << toxicity.CHAR_BITS, bool))
    w["word"], w["char"] = rng.standard_normal(w["word"].shape).astype(np.float32), rng.standard_normal(w["char"].shape).astype(np.float32)
    for c in ("cf", "cb", "o"):
        w[c] = rng.standard_normal(w[c].shape).astype(np.float32)
    w |= {"scale": np.array([scale]), "shift": np.array([shift])}
    words = [*known, *(f"v{i}" for i in range(40)), "Bad", "BAD!", "é", "中文"]
    texts = [" ".join(rng.choice(words, n)) for n in (1, 2, 5, toxicity.WINDOW - 1, toxicity.WINDOW, toxicity.WINDOW + 1, 61, 200)]
    got = toxicity.Scorer(w).scores(*utf8(pa.array(texts)))
    for text, score in zip(texts, got, strict=True):
        own = text.split(" ")
        last = max(0, len(own) - toxicity.WINDOW)
        starts = sorted({min(i, last) for i in range(0, last + toxicity.STRIDE, toxicity.STRIDE)})
        top = max(plain_logit(own[i : i + toxicity.WINDOW], w) for i in starts)
        assert abs(score - 1 / (1 + np.exp(-(scale * top + shift)))) < 1e-4


def test_clashing_columns_nulls_and_long_texts(spark):
    docs = spark.createDataFrame([(1, None), (None, "one two"), (2, "word " * 30000), (2, "word " * 30000), (3, "")], "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS predicted", "true AS held_out", "0 AS toxic")
    got = toxicity.score(docs, weights()).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 2}) == 1
