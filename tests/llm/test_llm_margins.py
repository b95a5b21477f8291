"""Mixing under a budget: the margins of the final probabilities."""

import random

import numpy as np
import pytest

from newsmart.llm.mixing import bounded_rake, missed, mix, mix_with_margins, sampled, sampled_to_margins
from newsmart.llm.scratch import Scratch


def test_final_probabilities_meet_reachable_margins(spark):
    # Source c is small and topic y scarce: raked weights pass the tokens of several cells.
    tokens = {("a", "x"): 700, ("a", "y"): 100, ("b", "x"): 600, ("b", "y"): 40, ("c", "x"): 150, ("c", "y"): 110}
    cells = spark.createDataFrame([(s, t, n) for (s, t), n in tokens.items()], "source string, topic string, tokens long")
    shares = {"source": {"a": 0.4, "b": 0.4, "c": 0.2}, "topic": {"x": 0.6, "y": 0.4}}
    targets = {name: spark.createDataFrame(list(of.items()), "value string, share double") for name, of in shares.items()}
    plan, margins = bounded_rake(cells, targets, 0.5, Scratch(spark))
    out = plan.toPandas()
    taken, budget = out.tokens * out.probability, 0.5 * sum(tokens.values())
    assert out.probability.between(0, 1).all() and abs(taken.sum() / budget - 1) < 1e-3
    held = taken.groupby(out.source).sum() / budget
    assert all(abs(held[value] - share) < 1e-3 for value, share in shares["source"].items())
    assert abs(taken[out.topic == "y"].sum() - 250) < 0.5  # all there is; 340 are wanted
    rows = {(r.margin, r.value): (round(r.wish), round(r.got)) for r in missed(margins).collect()}
    assert rows == {("topic", "x"): (510, 600), ("topic", "y"): (340, 250)}


def test_a_whole_budget_keeps_all(spark):
    rows = [(at, "some words here " * (at % 7 + 1), f"s{at % 3 and 1}", "en" if at // 3 % 4 else None) for at in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    assert mix(frame, fraction=1.0).toPandas().kept.all()
    assert sampled(frame, fraction=1.0).count() == len(rows)
    kept, left = sampled_to_margins(frame, fraction=1.0)
    assert kept.columns == frame.columns and kept.count() == len(rows) and left.count() > 0


def reachable_shares(held, power, budget):
    """Brute force: raise all wishes alike until the budget is spent, no value beyond what it holds."""
    wish = held ** power / (held ** power).sum() * budget
    low, high = 0.0, 1e9
    for _ in range(300):
        scale = (low + high) / 2
        low, high = (scale, high) if np.minimum(wish * scale, held).sum() < budget else (low, scale)
    return np.minimum(wish * high, held)


@pytest.mark.parametrize("fraction", [0.1, 0.5, 0.9])
def test_margins_and_weights_equal_plain_raking(spark, fraction):
    draws = random.Random(2)
    rows, doc = [], 0
    for source in "abcdefgh":
        for lang in ("en", "de", None):
            for text in ("plain words ", "a | b ", "12 34 x "):
                size = draws.randrange(1, 400) * (30 if source == "a" else 1)
                rows.append((doc, text * size, source, lang))
                doc += 1
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    out, margins = mix_with_margins(frame, fraction)
    out, told = out.toPandas(), {(r.margin, r.value): r for r in margins.collect()}
    tokens, taken = out.tokens.to_numpy(float), (out.tokens * out.probability).to_numpy()
    assert ((out.probability >= 0) & (out.probability <= 1)).all() and abs(taken.sum() / tokens.sum() - fraction) < 1e-6
    weight, wants = tokens * fraction, {}
    for margin in ("source", "lang", "topic"):
        held = out.groupby(margin).tokens.sum()
        wants[margin] = dict(zip(held.index, reachable_shares(held.to_numpy(float), 0.5, fraction * tokens.sum())))
    for _ in range(300):  # one value after the other, each solved by bisection
        for margin, want in wants.items():
            for value, amount in want.items():
                mine = (out[margin] == value).to_numpy()
                low, high = 0.0, 1e6
                for _ in range(60):
                    factor = (low + high) / 2
                    low, high = (factor, high) if np.minimum(weight[mine] * factor, tokens[mine]).sum() < amount else (low, factor)
                weight[mine] *= high
        if all(abs(np.minimum(weight, tokens)[out[m] == v].sum() / a - 1) < 1e-9 for m, want in wants.items() for v, a in want.items()):
            break
    for margin, want in wants.items():
        for value, amount in want.items():
            got = taken[out[margin] == value].sum()
            assert abs(got / amount - 1) < 1e-3
            assert abs(told[margin, value].want / amount - 1) < 1e-6 and abs(told[margin, value].got / got - 1) < 1e-6
    assert np.allclose(np.minimum(weight, tokens), taken, rtol=1e-3, atol=1e-3)
