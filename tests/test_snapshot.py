"""Every analysis gives the same rows on a snapshot as on the star itself."""

import shutil

import pytest

from salescope.operators.quality import fk_violations
from salescope.plans.snapshot import UnmatchedKeys, from_snapshot, refresh_snapshot, write_snapshot
from salescope.registry import STAR_PARAMS, analyses, analysis_names
from salescope.sources.crm import ACCOUNTS_SCHEMA, PRODUCTS_SCHEMA, SALES_SCHEMA, TEAMS_SCHEMA, model_from_frames
from salescope.sources.star import from_star
from tests.conftest import rows
from tests.fixture_crm import ACCOUNTS, PRODUCTS, SALES, TEAMS

SF = "/root/testdata/sf0.001"
#: Listings of the tables; the plain names of a snapshot's fact are repaired by another path.
NAMES = [n for n in analysis_names(STAR_PARAMS) if n not in ("column_catalog", "string_columns", "distinct_counts")]


@pytest.fixture(scope="module")
def models(spark, tmp_path_factory):
    star = from_star(spark, SF)
    path = str(tmp_path_factory.mktemp("snapshot") / "deals")
    write_snapshot(star, path)
    return analyses(star, STAR_PARAMS), analyses(from_snapshot(spark, path, star), STAR_PARAMS)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(models, name):
    star, snapshot = models[0][name](), models[1][name]()
    rows = [sorted(map(repr, df.select(*sorted(df.columns)).collect())) for df in (star, snapshot)]
    assert rows[0] == rows[1]


def _crm(spark, sales):
    return model_from_frames(
        spark.createDataFrame(sales, SALES_SCHEMA),
        spark.createDataFrame(TEAMS, TEAMS_SCHEMA),
        spark.createDataFrame(PRODUCTS, PRODUCTS_SCHEMA),
        spark.createDataFrame(ACCOUNTS, ACCOUNTS_SCHEMA),
    )


def _files(path):
    return {p.relative_to(path).as_posix(): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def _deals(spark, path, model):
    return rows(from_snapshot(spark, str(path), model).frame())


CLOSE, STAGE = (SALES_SCHEMA.fieldNames().index(n) for n in ("close_date", "deal_stage"))


def test_refresh_writes_changed_partitions_only(spark, tmp_path):
    path = tmp_path / "deals"
    first = _crm(spark, SALES)
    assert refresh_snapshot(first, str(path)).rows == first.frame().count()
    assert _deals(spark, path, first) == rows(first.frame())
    before = _files(path)
    assert refresh_snapshot(first, str(path)).partitions == ()
    assert _files(path) == before

    # the value of one closed deal changes: its month is written again, no other
    i = next(i for i, r in enumerate(SALES) if r[CLOSE] is not None and r[STAGE] == "Won")
    sales = [list(r) for r in SALES]
    sales[i][SALES_SCHEMA.fieldNames().index("close_value")] = 987_654
    changed = _crm(spark, [tuple(r) for r in sales])
    part = ("Won", sales[i][CLOSE].strftime("%Y-%m"))
    assert refresh_snapshot(changed, str(path)).partitions == (part,)
    folder = f"deal_stage={part[0]}/close_month={part[1]}/"
    after = _files(path)
    assert {k: v for k, v in after.items() if not k.startswith(folder)} == {k: v for k, v in before.items() if not k.startswith(folder)}
    assert all(k not in before for k in after if k.startswith(folder))
    assert _deals(spark, path, changed) == rows(changed.frame())

    # a month without deals any more goes; a lost manifest means a whole rebuild
    rest = _crm(spark, [r for r in SALES if not (r[CLOSE] is not None and r[CLOSE].strftime("%Y-%m") == part[1])])
    assert part in refresh_snapshot(rest, str(path)).partitions
    assert _deals(spark, path, rest) == rows(rest.frame())
    shutil.rmtree(f"{path}.manifest")
    refresh_snapshot(changed, str(path))
    assert _deals(spark, path, changed) == rows(changed.frame())


def test_checks_in_the_pass_that_writes(spark, tmp_path):
    model = _crm(spark, SALES)
    bad = fk_violations(model).groupBy("relationship").sum("n_rows").collect()
    want = {d.name: 0 for d in model.dims} | {r[0].split("-> ")[1].split(".")[0]: r[1] for r in bad}
    assert any(want.values())
    path = tmp_path / "deals"
    report = write_snapshot(model, str(path))
    assert report.unmatched == want and report.rows == len(SALES)
    assert report.null_keys["accounts"] == model.fact().where("account is null").count()
    before = _files(path)
    for write in (write_snapshot, refresh_snapshot):
        with pytest.raises(UnmatchedKeys):
            write(model, str(path), fail_on_unmatched=True)
    assert _files(path) == before and [p.name for p in tmp_path.iterdir()] == ["deals"]

    known = {d.name: {r[0] for r in d.frame.select(d.key).collect()} | {None} for d in model.dims}
    at = {d.name: SALES_SCHEMA.fieldNames().index(d.key) for d in model.dims}
    clean = _crm(spark, [r for r in SALES if all(r[at[n]] in known[n] for n in known)])
    write_snapshot(clean, str(path), fail_on_unmatched=True)
    assert _deals(spark, path, clean) == rows(clean.frame())
