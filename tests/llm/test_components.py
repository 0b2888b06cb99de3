import random
from hashlib import md5

import pytest

from ridewright.llm.components import components


def digest(i):
    return md5(b"%d" % i).digest()


def plain(links):
    label = {x: x for link in links for x in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(label[a], label[b])
            changed |= label[a] != least or label[b] != least
            label[a] = label[b] = least
    return label


CASES = {
    "chain": [(i, i + 1) for i in range(60)],
    "star": [(0, i) for i in range(1, 60)],
    "mixed": [(random.Random(i).randrange(80), random.Random(-i).randrange(80)) for i in range(1, 60)],
    "none": [],
}


@pytest.mark.parametrize("case", CASES)
def test_components_equal_plain_spreading(spark, case):
    links = [(digest(a), digest(b)) for a, b in CASES[case] if a != b]
    rows = spark.createDataFrame(links + links[:3], "a binary, b binary")
    got = {bytes(r.node): bytes(r.label) for r in components(rows).collect()}
    assert got == plain(links)
