"""op8: the fit against a plain Bradley-Terry fit of the same preference pairs."""
import numpy as np


def newton(gaps, signs, reg):
    """Weights that minimise mean log(1 + exp(-sign gap.w)) + reg / 2 |w|^2, by Newton steps."""
    x = gaps * signs[:, None]
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(x @ w))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / len(x) + reg * np.eye(len(w)), -(x.T @ p) / len(x) + reg * w)
        w = w - step
        if np.abs(step).max() < 1e-12:
            break
    return w


def test_weights_equal_a_plain_fit(spark, monkeypatch):
    from test_joins import quality_rows

    from riskmart.llm import quality as Q
    rows, labels = quality_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = {}
    real = Q.materialize

    def kept(df, tag):
        held[tag] = real(df, tag)
        return held[tag]

    monkeypatch.setattr(Q, "materialize", kept)
    ranking = Q.quality_model(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    pairs = held["bt-pairs"].collect()
    gaps, signs = np.array([r.gap for r in pairs]), np.array([2 * r.label - 1 for r in pairs])
    assert len(pairs) > 100
    want = newton(gaps, signs, 1e-4)
    got = ranking.weights
    assert got @ want / np.sqrt((got @ got) * (want @ want)) > 0.999
    loss = lambda w: np.mean(np.logaddexp(0, -signs * (gaps @ w))) + 0.5e-4 * w @ w
    assert loss(got) <= loss(want) * 1.01 + 1e-4
    # every pair prefers a document of label 1 over one of label 0, and most pairs are ranked so
    assert np.mean(signs * (gaps @ got) > 0) > 0.95
