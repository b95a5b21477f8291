"""A hierarchical navigable small-world graph over one shard's vectors, in numpy.

A layer is a pair of flat arrays: ``nodes`` (which vectors it holds) and ``links`` (int32, one row of neighbour places
per node, -1 where there is none). Searches and insertions run for many vectors at a time. Vectors are lifted to equal
length by one more component, so that the largest inner product is the smallest distance and the graph's pruning rule,
which needs a metric, holds.
"""

from __future__ import annotations

import numpy as np

LINKS, BREADTH = 16, 64


def lifted(vectors: np.ndarray) -> np.ndarray:
    squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
    extra = np.sqrt(np.maximum(squares.max(initial=0.0) - squares, 0.0))
    return np.concatenate([vectors, extra[:, None]], axis=1).astype(np.float32)


def beam(vectors, links, queries, entries, breadth, size):
    """The ``breadth`` best places found per query among the first ``size``: (places, scores), best first, -1 where fewer.

    Four places are expanded per query and step; a place is scored once.
    """
    count, at_once = len(queries), 4
    rows = np.arange(count)[:, None]
    seen = np.zeros((count, size), bool)
    places = np.full((count, breadth), -1, np.int64)
    scores = np.full((count, breadth), -np.inf, np.float32)
    done = np.ones((count, breadth), bool)
    width = min(entries.shape[1], breadth)
    places[:, :width] = entries[:, :width]
    valid = places >= 0
    scores[valid] = np.einsum("kd,kd->k", vectors[places[valid]], queries[np.nonzero(valid)[0]])
    done[valid] = False
    seen[np.nonzero(valid)[0], places[valid]] = True
    live = np.arange(count)
    while len(live):
        own = np.arange(len(live))[:, None]
        waiting = np.where(done[live], -np.inf, scores[live])
        take = np.argpartition(-waiting, min(at_once, breadth) - 1, axis=1)[:, :at_once]
        chosen = np.where(np.isfinite(waiting[own, take]), places[live][own, take], -1)
        done[live[:, None], take] = True
        near = np.where(chosen[:, :, None] >= 0, links[chosen], -1).reshape(len(live), -1)
        near = np.sort(near, axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        fresh &= ~seen[live[:, None], near]
        who, where = np.nonzero(fresh)
        found = near[who, where]
        seen[live[who], found] = True
        gained = np.full(near.shape, -np.inf, np.float32)
        gained[who, where] = np.einsum("kd,kd->k", vectors[found], queries[live[who]])
        all_scores = np.concatenate([scores[live], gained], axis=1)
        all_places = np.concatenate([places[live], np.where(fresh, near, -1)], axis=1)
        all_done = np.concatenate([done[live], ~fresh], axis=1)
        best = np.argpartition(-all_scores, breadth - 1, axis=1)[:, :breadth]
        scores[live], places[live] = all_scores[own, best], all_places[own, best]
        done[live] = all_done[own, best]
        live = live[~done[live].all(axis=1)]
    order = np.argsort(-scores, axis=1, kind="stable")
    return places[rows, order], scores[rows, order]


def spread(vectors, places, scores, most):
    """Up to ``most`` of each row's candidates (best first): those nearer to the row than to any chosen one, then the
    best of the rest."""
    count, width = places.shape
    group = vectors[np.maximum(places, 0)]
    between = group @ group.transpose(0, 2, 1)
    crowd = np.full((count, width), -np.inf, np.float32)
    chosen = np.zeros((count, width), bool)
    number = np.zeros(count, np.int64)
    for at in range(width):
        take = (places[:, at] >= 0) & (number < most) & (scores[:, at] > crowd[:, at])
        chosen[:, at] = take
        number += take
        crowd = np.where(take[:, None], np.maximum(crowd, between[:, at]), crowd)
    rank = np.where(places < 0, 2 * width, np.where(chosen, 0, width)) + np.arange(width)
    order = np.argsort(rank, axis=1)[:, :most]
    picked = np.take_along_axis(places, order, axis=1)
    if picked.shape[1] < most:
        picked = np.pad(picked, ((0, 0), (0, most - picked.shape[1])), constant_values=-1)
    return picked


def _link_back(vectors, links, sources, targets):
    """Adds ``sources`` to the neighbours of ``targets``; a full row is chosen anew from old and new."""
    most = links.shape[1]
    order = np.lexsort((sources, targets))
    sources, targets = sources[order], targets[order]
    nodes, starts, numbers = np.unique(targets, return_index=True, return_counts=True)
    fits = (links[nodes] >= 0).sum(axis=1) + numbers <= most
    for node, start, number, fit in zip(nodes, starts, numbers, fits):
        if fit:
            used = int((links[node] >= 0).sum())
            links[node, used:used + number] = sources[start:start + number]
    full = np.flatnonzero(~fits)
    for part in np.array_split(full, max(1, len(full) // 256)):
        if not len(part):
            continue
        wide = np.full((len(part), most + int(numbers[part].max())), -1, np.int64)
        wide[:, :most] = links[nodes[part]]
        for row, at in enumerate(part):
            wide[row, most:most + numbers[at]] = sources[starts[at]:starts[at] + numbers[at]]
        scores = np.einsum("vkd,vd->vk", vectors[np.maximum(wide, 0)], vectors[nodes[part]])
        scores[wide < 0] = -np.inf
        best = np.argsort(-scores, axis=1, kind="stable")[:, :2 * most]
        wide, scores = np.take_along_axis(wide, best, axis=1), np.take_along_axis(scores, best, axis=1)
        links[nodes[part]] = spread(vectors, wide, scores, most)


def _layer(vectors, most, breadth, entry):
    """Links of one layer over ``vectors``, inserted in their order; ``entry(rows)`` gives places to start from."""
    size = len(vectors)
    links = np.full((size, most), -1, np.int32)
    inserted = 0
    while inserted < size:
        room = max(1, (32 << 20) // size)
        rows = np.arange(inserted, min(size, inserted + max(most, min(512, inserted, room))))
        places = np.empty((len(rows), 0), np.int64)
        scores = np.empty((len(rows), 0), np.float32)
        if inserted:
            places, scores = beam(vectors, links, vectors[rows], entry(rows), breadth, size)
        beside = vectors[rows] @ vectors[rows].T
        np.fill_diagonal(beside, -np.inf)
        together = np.concatenate([scores, beside], axis=1)
        known = np.concatenate([places, np.broadcast_to(rows, beside.shape)], axis=1)
        best = np.argsort(-together, axis=1, kind="stable")[:, :breadth]
        together, known = np.take_along_axis(together, best, axis=1), np.take_along_axis(known, best, axis=1)
        known = np.where(np.isfinite(together), known, -1)
        picked = spread(vectors, known, together, most // 2 if inserted else most)
        links[rows, :picked.shape[1]] = picked
        a, b = np.nonzero(picked >= 0)
        one, other = rows[a], picked[a, b]
        old = ~(links[other] == one[:, None]).any(axis=1)
        _link_back(vectors, links, one[old], other[old])
        inserted += len(rows)
    return links


def build(vectors: np.ndarray, links: int = LINKS, breadth: int = BREADTH, seed: int = 1) -> list:
    """Layers from the top: (nodes, links), where links hold places within the layer. Nodes of a higher layer come
    first in every lower one, so a place found above is the same place below."""
    level = np.floor(-np.log(1 - np.random.default_rng(seed).random(len(vectors))) / np.log(links)).astype(int)
    order = np.argsort(-level, kind="stable")
    points = lifted(vectors)[order]
    layers = []
    for height in range(int(level.max(initial=0)), -1, -1):
        size = int((level >= height).sum())
        above = list(layers)

        def entry(rows):
            return descend(points, above, points[rows]) if above else np.zeros((len(rows), 1), np.int64)

        layers.append((order[:size], _layer(points[:size], 2 * links if height == 0 else links, breadth, entry)))
    return layers


def descend(points, layers, queries, breadth: int = 4):
    """Places to start from below ``layers``; the first node is the entry of all."""
    entries = np.zeros((len(queries), 1), np.int64)
    for nodes, links in layers:
        entries, _ = beam(points, links, queries, entries, breadth, len(nodes))
    return entries


def search(vectors: np.ndarray, layers: list, queries: np.ndarray, breadth: int) -> np.ndarray:
    """Rows of ``vectors`` near each query by inner product, up to ``breadth`` of them, -1 where fewer."""
    order = layers[-1][0]
    points = lifted(vectors)[order]
    lengthened = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1).astype(np.float32)
    out = []
    step = max(1, min(512, (32 << 20) // max(1, len(vectors))))
    for at in range(0, len(queries), step):
        part = lengthened[at:at + step]
        places, _ = beam(points, layers[-1][1], part, descend(points, layers[:-1], part), breadth, len(order))
        out.append(np.where(places >= 0, order[places], -1))
    return np.concatenate(out)
