"""Links found when only lists are asked that a step in a random direction reaches."""

import numpy as np

from corpweave.llm import embedding_neighbours as e


def test_links_near_the_threshold_are_found(spark):
    """Neighbours in random directions, at cosines just above the threshold, among unclustered vectors."""
    draw = np.random.default_rng(6)
    x = draw.standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    d = draw.standard_normal((600, 64))
    d -= (d * x[:600]).sum(1, keepdims=True) * x[:600]
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    angle = np.arccos(draw.uniform(0.9501, 0.97, 600))[:, None]
    every = np.concatenate([x, np.cos(angle) * x[:600] + np.sin(angle) * d])
    unit = every / np.linalg.norm(every, axis=1, keepdims=True)
    links = (unit @ unit.T >= e.COSINE).sum(1) - 1
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(every.tolist())], "vec_id bigint, embedding array<double>")
    exact = {r["vec_id"]: r["n_links"] for r in e.linked(frame, spread=None).collect()}
    assert [exact[i] for i in range(len(every))] == links.tolist()
    found = {r["vec_id"]: r["n_links"] for r in e.linked(frame).collect()}
    assert all(found[i] <= links[i] for i in found)
    assert sum(found.values()) >= 0.99 * links.sum() > 1000


def test_fewer_lists_are_asked_but_none_less_in_few_dimensions():
    assert e.across(0.3, 16, e.SPREAD) == e.across(0.3, 4, e.SPREAD) == e.across(0.3, 1024, None) == 0.3
    assert np.isclose(e.across(0.3, 64, e.SPREAD), 0.15)
