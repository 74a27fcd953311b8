"""Families of failure signatures against all pairs."""

import random

from runpulse.functions.text import signature
from runpulse.operators import diagnosis


def test_families_are_the_components_of_all_near_pairs(spark):
    rng = random.Random(11)
    name = lambda: "".join(rng.choice("bcdfghklmnprstvz") + rng.choice("aeiou") for _ in range(4))
    pool = [name() for _ in range(60)]
    texts = []
    for _ in range(12):
        base = rng.sample(pool, rng.randint(5, 12))
        for _ in range(25):
            w = list(base)
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = rng.choice(pool)
            texts.append(" ".join(w[: rng.randint(4, len(w))]))
    frame = spark.createDataFrame([(t,) for t in [*texts, None]], "error_message string")
    rows = frame.select(signature("error_message").alias("s"), diagnosis.F.md5(signature("error_message")).alias("f")).distinct().collect()
    sets = {r.f: set(r.s.split(" ")) for r in rows if r.s is not None}
    family = {f: f for f in sets}
    near = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in near:
            least = min(family[a], family[b])
            changed |= family[a] != least or family[b] != least
            family[a] = family[b] = least
    got = diagnosis.signature_families(frame).collect()
    assert len(got) == len(sets) and {r.fingerprint: r.family for r in got} == family
