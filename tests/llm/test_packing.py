"""The joint choice of bin sizes against a plain search of every bin, and against all ways to pack small shards."""

import random

import pytest

from tidemark.llm import packing


def plainly(items, opened):
    """Contents of bins, each item into the open bin with the least room that holds it, found by looking at all of them."""
    bins = []
    for n in items:
        fitting = [b for b in bins if b["room"] >= n]
        if fitting:
            b = min(fitting, key=lambda b: b["room"])
        else:
            b = {"room": min(c for c in opened if c >= n), "used": 0}
            bins.append(b)
        b["room"] -= n
        b["used"] += n
    return [b["used"] for b in bins]


def paid(contents, sizes):
    return sum(packing.cost(min(c for c in sizes if c >= used)) for used in contents)


def least_cost(items, sizes):
    """The cost of the best of all partitions of items into bins of sizes."""

    def place(rest, bins):
        if not rest:
            return paid(bins, sizes)
        options = [place(rest[1:], bins[:i] + [b + rest[0]] + bins[i + 1 :]) for i, b in enumerate(bins) if b + rest[0] <= max(sizes)]
        return min([*options, place(rest[1:], [*bins, rest[0]])])

    return place(items, [])


@pytest.mark.parametrize("seed", range(40))
def test_the_cheapest_policy_is_kept(seed):
    rng = random.Random(seed)
    sizes = sorted(rng.sample([512, 1024, 2048, 3000, 4096, 8192], rng.randint(1, 4)))
    items = sorted((rng.choice([rng.randint(1, sizes[-1]), rng.randint(1, sizes[0])]) for _ in range(rng.randint(0, 120))), reverse=True)
    bins, final = packing.pack_shard(items, sizes)
    contents = [0] * len(final)
    for b, n in zip(bins, items):
        contents[b] += n
    assert final == [min(c for c in sizes if c >= used) for used in contents]  # as small as the contents allow
    assert paid(contents, sizes) == pytest.approx(min(paid(plainly(items, sizes[i:]), sizes) for i in range(len(sizes))))


@pytest.mark.parametrize("seed", range(60))
def test_small_shards_are_near_the_best_of_all_packings(seed):
    """Never below the least cost, and at most half as much again, for seven items at most."""
    rng = random.Random(1000 + seed)
    items = sorted((rng.randint(1, 8192 // rng.choice([1, 2, 4])) for _ in range(rng.randint(1, 7))), reverse=True)
    _, final = packing.pack_shard(items)
    got, best = sum(map(packing.cost, final)), least_cost(items, packing.CAPACITIES)
    assert best <= got + 1e-6 and got <= 1.5 * best
