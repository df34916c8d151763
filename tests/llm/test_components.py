"""Connected components, in one task and in rounds."""

import random
from pathlib import Path

import pytest

from millrace.llm import _components
from millrace.llm._common import mark, written_since

SETTINGS = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def brute_labels(pairs):
    label = {x: x for p in pairs for x in p if p[0] != p[1]}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if a != b and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


def graphs():
    r = random.Random(4)
    ids = [r.getrandbits(63) - 2**62 for _ in range(90)]
    path = r.sample(ids[:40], 40)
    return {
        "path": [*zip(path, path[1:], strict=False)],
        "random": [(r.choice(ids), r.choice(ids)) for _ in range(70)],
        "star, loops, repeats": [(ids[0], x) for x in ids[1:30]] + [(x, x) for x in ids[25:35]] + [(ids[40], ids[41])] * 3 + [(ids[41], ids[40])],
        "loops only": [(1, 1)],
    }


@pytest.mark.parametrize("one_task", [0, 1 << 18])
@pytest.mark.parametrize("name", list(graphs()))
def test_labels(spark, monkeypatch, one_task, name):
    monkeypatch.setattr(_components, "ONE_TASK", one_task)
    pairs = graphs()[name]
    got = _components.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in got} == brute_labels(pairs) and len(got) == len({r["node"] for r in got})


def test_no_edges(spark):
    assert _components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_small_graph_writes_few_files(spark):
    """A graph that one task can hold is not written again each round, a file a partition."""
    before = {k: spark.conf.get(k) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        begin = mark()
        _components.components(spark.createDataFrame(graphs()["path"], "a long, b long")).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = [f for p in written_since(begin) for f in Path(p.removeprefix("file://")).glob("part-*")]
    assert len(files) <= 33  # the edges' partitions, and one of labels
