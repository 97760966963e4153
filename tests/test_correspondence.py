"""Chains of establishment ids against following them one by one."""

import random

import pytest

from conftest import values
from starmart.operators import correspondence
from starmart.plans import kpis
from starmart.plans import rebuild as mart
from starmart.session import new_folder
from test_plans import sources  # noqa: F401


def followed(pairs):
    targets = {}
    for a, b in pairs:
        a, b = ((x or "").strip().lstrip("0") or "0" for x in (a, b))
        if a != "0" and b != "0" and a != b:
            targets.setdefault(a, set()).add(b)
    out = []
    for start in targets:
        at, seen = start, set()
        while at in targets and len(targets[at]) == 1 and at not in seen:
            seen.add(at)
            at = next(iter(targets[at]))
        status = "conflict" if len(targets.get(at, ())) > 1 else "cycle" if at in seen else "resolved"
        out.append((start, at if status == "resolved" else None, status))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_chains(rows, seed):
    rng = random.Random(seed)
    pairs = [(f"00{rng.randint(1, 60)} ", str(rng.randint(1, 60))) for _ in range(45)]
    pairs += [(str(100 + k), str(101 + k)) for k in range(37)] + [(None, "5"), ("7", " "), ("000", "1"), ("9", "009")]
    pairs += pairs[:5]
    found = correspondence.resolve(rows("internal string, official string", *pairs))
    assert values(found) == values_of(followed(pairs))


def values_of(found):
    return sorted(found, key=lambda r: [(v is None, v) for v in r])


def test_no_correspondence(rows):
    assert correspondence.resolve(rows("internal string, official string")).count() == 0


def test_names_appear_where_a_mapping_is_given(spark, sources, rows):  # noqa: F811
    """Consultations at 0, 1 and 2; the register knows 1 (Un) and 55."""
    without = mart.rebuild(spark, sources, new_folder(spark, "mart"), mart.EXTENDED).star()
    sources.correspondence = rows("internal string, official string", ("002", "77"), ("77", "1"), ("0003", "1"))
    run = mart.rebuild(spark, sources, new_folder(spark, "mart"), mart.EXTENDED)
    names = lambda star: {r.etablissement for r in kpis.consultations_by_establishment(star).collect()}
    assert "Étab. 2" in names(without) and names(run.star()) == names(without) - {"Étab. 2"}
    assert values(run.read("etablissements_correspondance")) == [("2", "1", "resolved"), ("3", "1", "resolved"),
                                                                 ("77", "1", "resolved")]
    assert run.read("fait_consultation").count() == 120
