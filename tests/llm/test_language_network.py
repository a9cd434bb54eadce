"""The byte network held against loops over bytes, filters and classes, and against differences."""

import math

import numpy as np

from adfacts.llm.language_id import UNKNOWN, WIDTHS, WINDOW, ByteNetwork, windows_of

LABELS = ["de", "en", "fr"]
TEXTS = ["The cat sat on the mat.", "Größe und Maß " * 40, "", "x", "déjà vu " * 200]


def network(seed=3):
    made = ByteNetwork.fresh(LABELS, seed)
    rng = np.random.default_rng(seed)
    wide = [p.astype(np.float64) for p in made.parameters()]
    embedding, filters, biases = wide[0], wide[1 : 1 + len(WIDTHS)], wide[1 + len(WIDTHS) : -2]
    biases = [rng.normal(0, 0.3, b.shape) for b in biases]
    return ByteNetwork(LABELS, embedding, filters, biases, wide[-2], wide[-1])


def plain_probabilities(net, window):
    """One window, place by place; every filter sees the places at which the widest one fits."""
    features = []
    for width, kernel, bias in zip(WIDTHS, net.filters, net.biases):
        for f in range(kernel.shape[1]):
            best = max(
                float(np.concatenate([net.embedding[b] for b in window[at : at + width]]) @ kernel[:, f])
                for at in range(WINDOW - max(WIDTHS) + 1)
            )
            features.append(max(best + bias[f], 0.0))
    scores = [
        sum(x * net.weights[i, k] for i, x in enumerate(features)) + net.offset[k]
        for k in range(len(LABELS))
    ]
    powers = [math.exp(x - max(scores)) for x in scores]
    return [p / sum(powers) for p in powers]


def test_windows_hold_every_byte():
    for text in TEXTS:
        data = text.encode()
        windows = windows_of(data)
        assert windows.shape[1] == WINDOW and len(windows) == max(1, -(-len(data) // WINDOW))
        assert windows.tobytes().rstrip(b"\0") == data.rstrip(b"\0")


def test_forward_pass():
    net = network()
    windows = np.concatenate([windows_of(t.encode()) for t in TEXTS[:3]])[:4]
    expected = [plain_probabilities(net, w) for w in windows]
    np.testing.assert_allclose(net.probabilities(windows), expected, rtol=1e-9)


def test_whole_texts_are_means_of_windows_by_their_bytes():
    net = network()
    labels, scores = net.predict([*TEXTS, None])
    for text, label, score in zip([*TEXTS, None], labels, scores):
        if not text:
            assert (label, score) == (UNKNOWN, 0.0)
            continue
        data = text.encode()
        total = np.zeros(len(LABELS))
        for n, window in enumerate(windows_of(data)):
            total += min(WINDOW, len(data) - n * WINDOW) * np.array(plain_probabilities(net, window))
        assert label == LABELS[int(total.argmax())]
        assert math.isclose(score, total.max() / len(data), rel_tol=1e-9)


def test_gradients_equal_differences():
    net = network(5)
    windows = np.concatenate([windows_of(t.encode()) for t in (TEXTS[0], TEXTS[1])])[:3]
    target = np.array([1, 0, 2])[: len(windows)]

    def loss():
        chosen = net.probabilities(windows)[np.arange(len(target)), target]
        return -np.log(chosen).mean()

    rng, step = np.random.default_rng(1), 1e-6
    for values, slopes in zip(net.parameters(), net.gradients(windows, target)):
        assert values.shape == slopes.shape
        strongest = np.argsort(-np.abs(slopes), axis=None)[:5]
        for at in [*strongest, *rng.integers(0, values.size, 5)]:
            place = np.unravel_index(at, values.shape)
            before = values[place]
            values[place] = before + step
            above = loss()
            values[place] = before - step
            below = loss()
            values[place] = before
            assert math.isclose((above - below) / (2 * step), slopes[place], rel_tol=1e-4, abs_tol=1e-7)
