"""Training of linear machines in the driver: memory and weights."""

import tracemalloc

import numpy as np

from newsmart.llm.svm import train


def test_training_holds_one_copy_of_the_sample():
    draws = np.random.RandomState(1)
    features = draws.random_sample((500, 1024)).astype(np.float32)
    positive = draws.random_sample(500) < 0.4
    tracemalloc.start()
    train(features, positive, passes=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.2 * 8 * features.size


def test_machines_tell_rows_apart():
    draws = np.random.RandomState(2)
    features = draws.standard_normal((300, 20)).astype(np.float32)
    positive = features[:, 0] + features[:, 1] > 0.2
    weights = train(features, positive)
    assert (((features @ weights[:-1] + weights[-1]) > 0) == positive).mean() > 0.95
