"""The credit tables as CSV files go through every block and into one matrix."""

import random

import pytest

from relfold.operators.rollup import common_values
from relfold.plans.matrix import block_builders, feature_matrix
from relfold.sources import layouts


def value(rnd, column, kind, n):
    if column == "TARGET":
        return str(n % 2)
    if column in ("SK_ID_CURR",):
        return str(n % 12)
    if column in ("SK_ID_PREV", "SK_ID_BUREAU"):
        return str(n % 40)
    if column == "STATUS":
        return rnd.choice(["C", "X", "0", "1", "5"])
    if column == "FLAG_LAST_APPL_PER_CONTRACT" or column.startswith("FLAG_OWN"):
        return rnd.choice("YN")
    if kind == "string":
        return rnd.choice(["Active", "Completed", "Signed: a/b", ""])
    if column.startswith(("FLAG", "NFLAG")):
        return rnd.choice("01")
    if column.startswith(("DAYS", "MONTHS")):
        return str(-rnd.randint(1, 60 if column.startswith("MONTHS") else 3000))
    return "" if kind == "double" and rnd.random() < 0.15 else str(rnd.randint(0, 9))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rnd, base = random.Random(5), tmp_path_factory.mktemp("credit")

    def write(name, layout, rows, start=0, drop=()):
        columns = [(c, t) for c, t, _ in layouts.lines(layout) if c not in drop]
        text = [",".join(["extra", *[c for c, _ in columns]])]
        text += [",".join(["z", *[value(rnd, c, t, n) for c, t in columns]]) for n in range(start, start + rows)]
        (base / f"{name}.csv").write_text("\n".join(text) + "\n")

    write("application_train", layouts.applicant_layout(), 8)
    write("application_test", layouts.applicant_layout(), 4, 8, drop=["TARGET"])
    for name, (_, layout) in layouts.FILES.items():
        write(name, layout, 120)
    return str(base)


@pytest.mark.parametrize("variants", [False, True])
def test_matrix_from_files(spark, folder, variants):
    roles = layouts.read_roles(spark, folder)
    assert roles["applicant"].count() == 12 and roles["applicant"].where("label is null").count() == 4
    matrix = feature_matrix(block_builders(roles, variants, min_count=0), "entity_id")
    assert len(set(matrix.columns)) == len(matrix.columns) > (150 if variants else 900)
    rows = matrix.collect()
    assert len(rows) == 12 and {r["entity_id"] for r in rows} == set(range(12)) and sum(r["label"] is None for r in rows) == 4


@pytest.mark.parametrize("name,variants,column,count", [
    ("applications", False, "appl_client_type", 3), ("credits", False, "credit_is_status", 2), ("credits2", True, "credit2_status", 1),
    ("snapshots2", True, "snap2_status", 1), ("applications2", True, "appl2_client_type", 3), ("cards", False, "card_status", 2), ("cards2", True, "card2_status", 4)])
def test_rare_categories_get_no_column(spark, folder, name, variants, column, count):
    roles = layouts.read_roles(spark, folder)
    shown = {m: [c for c in block_builders(roles, variants, min_count=m)[name]().columns if c.startswith(column)] for m in (0, 100)}
    assert len(shown[0]) >= count and not shown[100]


def test_common_values(spark):
    df = spark.createDataFrame([("a", "x")] * 5 + [("b", "x")] * 3 + [(None, "y")] * 2, "p string, q string")
    assert common_values(df, ["p", "q"]) == {"p": ["a", "b", None], "q": ["x", "y"]}
    assert common_values(df, ["p", "q"], 3) == {"p": ["a", "b"], "q": []}
    assert common_values(df.limit(0), ["p"], 1) == {"p": []} and common_values(df, []) == {}
    with pytest.raises(ValueError):
        common_values(df, ["p"], limit=1)
