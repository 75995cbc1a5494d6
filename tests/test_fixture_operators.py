"""Single operators on the hand-made fixture; expected rows worked out by hand."""

from __future__ import annotations

import datetime as dt

import pytest

from salescope.operators import cumulative, explore, performance, quality, rank, report, segment, share
from tests.conftest import rows
from tests.fixture_crm import REPAIR, build_model

D = dt.date


def test_orphans_before_and_after_repair(spark):
    raw = build_model(spark, repaired=False)
    assert rows(quality.orphan_products(raw)) == sorted(
        [("AlphaPlus",), ("Unknown Gadget",), (None,)], key=repr
    )
    fixed = build_model(spark, repaired=True)
    assert rows(quality.orphan_products(fixed)) == sorted([("Unknown Gadget",), (None,)], key=repr)


def test_repair_by_mapping_and_by_canonical_spelling(spark):
    raw = build_model(spark, repaired=False)
    sales = raw.sales(["opportunity_id", "product"])
    mapped = quality.repair_values(sales, "product", REPAIR)
    assert mapped.columns == sales.columns
    assert dict(rows(mapped))["o9"] == "Alpha Plus"
    messy = spark.createDataFrame([("x1", "  alpha basic "), ("x2", "BETA ONE"), ("x3", "nope")], "id string, product string")
    canon = quality.repair_values(messy, "product", canonical=raw.table("products"))
    assert dict(rows(canon)) == {"x1": "Alpha Basic", "x2": "Beta One", "x3": "nope"}


def test_fk_violations_exempt_null_keys(crm):
    got = rows(quality.fk_violations(crm))
    assert got == sorted(
        [
            ("sales.sales_agent -> teams.sales_agent", "Ghost Agent", 1),
            ("sales.product -> products.product", "Unknown Gadget", 1),
            ("sales.account -> accounts.account", "Zeta Corp", 1),
        ],
        key=repr,
    )
    assert rows(quality.duplicate_keys(crm)) == []


def test_null_counts_after_joins(crm):
    (r,) = quality.null_counts(crm).collect()
    d = r.asDict()
    assert d["null_manager"] == 1  # agent missing from teams
    assert d["null_product"] == 1
    assert d["null_series"] == 2  # NULL product + unknown product
    assert d["null_account"] == 1
    assert d["null_sector"] == 2  # NULL account + unknown account
    assert d["null_office_location"] == 4  # + account whose location is NULL (2 deals)
    assert d["null_subsidiary_of"] == 15
    assert d["null_engage_date"] == 1
    assert d["null_close_date"] == 2
    assert d["null_close_value"] == 2
    assert d["null_opportunity_id"] == 0


def test_column_catalog_lists_schema(crm):
    got = {(t, c): ty for t, c, ty, _, _ in rows(quality.column_catalog(crm))}
    assert got[("sales", "close_value")] == "bigint"
    assert got[("accounts", "revenue")] == "decimal(12,2)"
    strings = rows(quality.column_catalog(crm, data_type="string"), "table_name", "column_name")
    assert ("accounts", "subsidiary_of") in strings and ("products", "sales_price") not in strings


def test_kpi_measures(crm):
    got = dict(rows(explore.kpi_measures(crm)))
    assert got == {
        "total sales": 3053.0,
        "qty sold": 12.0,
        "avg price": 218.0,  # 3053 / 14 valued deals, truncated
        "avg nego days": 6.0,  # 85 / 14
        "deal win %": 85.71,  # 12 won of 14 closed
    }


def test_month_of_year_merges_years(crm):
    got = {m: (q, t) for m, q, t in rows(explore.month_of_year_sales(crm))}
    assert got[1] == (5, 1350)


def test_magnitude_validates_dimension(crm):
    with pytest.raises(ValueError):
        explore.magnitude(crm, "no_such_column")
    got = rows(explore.magnitude(crm, "regional_office"))
    assert (None, 1001, 1) in got and ("East", 1550, 6) in got
    all_dims = rows(explore.magnitude_all(crm, ["regional_office", "series"]))
    assert ("regional_office", "East", 1550, 6) in all_dims
    assert ("series", "Beta", 1801, 4) in all_dims


def test_series_share_equals_part_to_whole(crm):
    a = rows(share.series_share(crm))
    b = rows(share.series_part_to_whole(crm))
    assert a == b == [("Alpha", 1252, 41.01), ("Beta", 1801, 58.99)]


def test_home_vs_other_and_non_home_products(crm):
    assert rows(share.home_vs_other(crm, home="Homeland")) == [("Homeland", 1401, 45.89), ("Other", 1652, 54.11)]
    got = rows(share.non_home_products(crm, home="Homeland"))
    # deals of accounts with NULL location are dropped by `!=`
    assert got == [
        ("Alpha Basic", 3, 402, 42.86, 134.0),
        ("Alpha Plus", 1, 150, 14.29, 150.0),
        ("Beta One", 3, 800, 42.86, 266.67),
    ]


def test_sector_pareto_running_share(crm):
    got = rows(share.sector_pareto(crm))
    by_sector = {s: (t, p, r) for s, t, p, r in got}
    assert by_sector["retail"] == (1601, 52.44, 52.44)
    assert by_sector["tech"] == (1151, 37.7, 90.14)
    assert by_sector["finance"][2] == pytest.approx(98.36)
    assert by_sector[None] == (50, 1.64, 100.0)


@pytest.mark.parametrize("strategy", ["window", "distributed"])
def test_rank_tiles_and_segments(crm, strategy):
    ranks = {a: r for a, _, r in rows(rank.agent_revenue_rank(crm, strategy=strategy))}
    assert ranks == {
        "Ghost Agent": 1,
        "Blake Reed": 2,
        "Avery Stone": 3,
        "Casey Hart": 4,
        "Drew Lane": 5,
        "Ellis Ford": 5,
    }
    tiers = {a: t for a, _, _, t in rows(rank.agent_tier(crm, strategy=strategy))}
    # 6 agents in 4 tiles: sizes 2, 2, 1, 1; equal revenue broken by name
    assert tiers == {
        "Ghost Agent": 1,
        "Blake Reed": 1,
        "Avery Stone": 2,
        "Casey Hart": 2,
        "Drew Lane": 3,
        "Ellis Ford": 4,
    }
    seg = {a: s for a, _, s in rows(segment.agent_segment(crm, outlier="Drew Lane", strategy=strategy))}
    assert seg["Drew Lane"] == "Top Performer"
    assert seg["Casey Hart"] == "Strong Performer"
    assert seg["Ellis Ford"] == "Needs Improvement"


def test_agent_segment_excluding_outlier(crm):
    seg = {a: s for a, _, s in rows(segment.agent_segment(crm, outlier="Ghost Agent", exclude_outlier=True))}
    # without Ghost Agent: 5 agents, tiles 2, 1, 1, 1
    assert seg == {
        "Ghost Agent": "Top Performer",
        "Blake Reed": "Top Performer",
        "Avery Stone": "Top Performer",
        "Casey Hart": "Strong Performer",
        "Drew Lane": "Developing Performer",
        "Ellis Ford": "Needs Improvement",
    }


def test_top_agents(crm):
    top = rank.top_agents_by_value(crm, n=3).collect()
    assert [r.sales_agent for r in top] == ["Ghost Agent", "Blake Reed", "Avery Stone"]
    win = {r.sales_agent: (r.total_deals, r.won_deals, r.win_rate) for r in rank.top_agents_by_win_rate(crm, n=10).collect()}
    assert win["Casey Hart"] == (3, 2, 66.67)  # open deal counts in the denominator
    assert win["Finley Moss"] == (1, 0, 0.0)


def test_threshold_date(crm):
    assert rows(cumulative.threshold_date(crm, 500)) == [
        ("Avery Stone", D(2023, 3, 15)),
        ("Blake Reed", D(2023, 1, 10)),  # two deals of one day cross it together
        ("Ghost Agent", D(2023, 5, 4)),
    ]


def test_cumulative_deals_last_value_is_total(crm):
    for _, _, _, cum, total in rows(cumulative.cumulative_deals_by_product(crm)):
        assert cum <= total
    got = rows(cumulative.cumulative_deals_by_product(crm))
    alpha = [r for r in got if r[0] == "Alpha Basic"]
    assert alpha[-1][3] == alpha[-1][4] == 5


def test_focal_agent_share(crm):
    got = {p: (f, o, pct) for p, f, o, pct in rows(cumulative.focal_agent_share(crm, "Blake Reed"))}
    assert got["Beta One"] == (2, 2, 50.0)
    assert got["Alpha Plus"] == (1, 2, 33.33)
    assert got["Alpha Basic"] == (0, 5, 0.0)


def test_new_accounts_by_month(crm):
    assert rows(cumulative.new_accounts_by_month(crm)) == [
        ("23-01", 2, 2),
        ("23-02", 2, 4),  # NULL account counts as one account
        ("23-03", 1, 5),
        ("23-06", 1, 6),
    ]


def test_win_rates_over_closed_deals(crm):
    got = {(o, m): (t, w, r) for o, m, t, w, r in rows(performance.manager_win_rate(crm))}
    assert got[("East", "Mgr One")] == (7, 6, 85.71)
    assert got[("West", "Mgr Two")] == (4, 3, 75.0)
    assert got[("North", "Mgr Three")] == (2, 2, 100.0)
    assert got[(None, None)] == (1, 1, 100.0)


def test_negotiation_days_truncate(crm):
    got = dict(rows(performance.negotiation_days(crm)))
    assert got["Avery Stone"] == 12  # 37 / 3
    assert got["Casey Hart"] == 2  # 5 / 2


def test_sector_performance_and_frequency(crm):
    perf = {r[0]: r[1:] for r in rows(performance.sector_performance(crm))}
    assert perf["retail"] == (400, 1601, "52.44%", 1)
    assert perf[None] == (50, 50, "1.64%", 4)
    freq = {r[0]: r[1:] for r in rows(performance.sector_frequency(crm))}
    assert freq["retail"] == (2, 4, 1601, 400, 2.0)
    assert freq["tech"] == (2, 5, 1151, 230, 2.5)
    assert freq[None] == (0, 1, 50, 50, None)  # no account: guarded division


def test_account_segment_single_account_region(crm):
    got = {a: (w, s) for a, _, w, s in rows(segment.account_segment(crm, home="Homeland", home_label="Home", other_label="Away"))}
    assert got["Acorn Ltd"] == (3, "Home Regular")  # only home account: no stdev
    assert got["Cedar Inc"] == (4, "Away VIP")
    assert got[None] == (1, "Away Regular")


def test_account_segment_inclusive_bounds(spark):
    from salescope.sources.crm import model_from_frames
    from tests.fixture_crm import ACCOUNTS, PRODUCTS, TEAMS
    from salescope.sources.crm import ACCOUNTS_SCHEMA, PRODUCTS_SCHEMA, SALES_SCHEMA, TEAMS_SCHEMA

    deals = []
    for account, n in [("Birch Co", 1), ("Cedar Inc", 3), ("Elm Group", 5)]:  # avg 3, stdev 2
        for i in range(n):
            deals.append((f"{account}{i}", "Avery Stone", "Beta One", account, "Won", D(2023, 1, 1), D(2023, 1, 2), 10))
    model = model_from_frames(
        spark.createDataFrame(deals, SALES_SCHEMA),
        spark.createDataFrame(TEAMS, TEAMS_SCHEMA),
        spark.createDataFrame(PRODUCTS, PRODUCTS_SCHEMA),
        spark.createDataFrame(ACCOUNTS, ACCOUNTS_SCHEMA),
    )
    got = {a: s for a, _, _, s in rows(segment.account_segment(model, home="Homeland", other_label="Away"))}
    assert got == {"Birch Co": "Away Emerging", "Cedar Inc": "Away Regular", "Elm Group": "Away VIP"}


def test_sales_insights_grains(crm):
    view = {(m, a, p): r for m, a, _, p, *r in rows(report.sales_insights_view(crm))}
    assert view[("2023-01", "Avery Stone", "Alpha Basic")] == [100, None, None, 100, 1]
    assert view[("2023-01", "Avery Stone", "Alpha Plus")] == [300, 100, 200.0, 400, 2]
    assert view[("2023-03", "Avery Stone", "Alpha Basic")] == [200, 300, -33.333333, 600, 3]
    monthly = {(m, a): r for m, a, _, *r in rows(report.agent_month_insights(crm))}
    assert monthly[("2023-01", "Avery Stone")] == [400, None, None, 400, 2]
    assert monthly[("2023-03", "Avery Stone")] == [200, 400, -50.0, 600, 3]  # Feb has no deal
    assert monthly[("2023-06", "Ellis Ford")] == [101, 0, None, 101, 2]  # previous revenue 0
    # the corrected report's last month per agent equals the agent's revenue
    revenue = dict(rows(rank.agent_revenue(crm)))
    last = {}
    for (m, a), r in sorted(monthly.items()):
        last[a] = r[3]
    assert last == revenue


def test_exploration_tables(crm):
    assert rows(explore.team_size(crm)) == sorted(
        [("East", "Mgr One", 2), ("West", "Mgr Two", 2), ("North", "Mgr Three", 2)], key=repr
    )
    assert rows(explore.account_count(crm)) == [(5,)]
    assert rows(explore.accounts_by_holding(crm)) == [("Acorn Ltd", 1)]
    assert dict(rows(explore.deals_by_stage(crm))) == {"Won": 12, "Lost": 2, "Engaging": 1, "Prospecting": 1}
    (b,) = rows(explore.date_bounds(crm))
    assert b == (D(2023, 1, 2), D(2024, 1, 15), D(2023, 1, 10), D(2024, 1, 20))
    numbering = rows(explore.product_numbering(crm))
    assert numbering == [("Alpha", "Alpha Basic", 1), ("Alpha", "Alpha Plus", 2), ("Beta", "Beta One", 1)]


ALL_OPERATORS = [
    (quality.orphan_products, {}),
    (quality.value_repair, {}),
    (quality.fk_violations, {}),
    (quality.duplicate_keys, {}),
    (quality.null_counts, {}),
    (quality.column_catalog, {}),
    (explore.product_numbering, {}),
    (explore.team_size, {}),
    (explore.account_count, {}),
    (explore.accounts_by_sector, {}),
    (explore.accounts_by_location, {}),
    (explore.accounts_by_holding, {}),
    (explore.deals_by_stage, {}),
    (explore.date_bounds, {}),
    (explore.month_of_year_sales, {}),
    (explore.kpi_measures, {}),
    (explore.magnitude_all, {}),
    (share.series_share, {}),
    (share.location_share, {}),
    (share.sector_pareto, {}),
    (share.series_part_to_whole, {}),
    (share.home_vs_other, {"home": "Homeland"}),
    (share.non_home_products, {"home": "Homeland"}),
    (rank.top_agents_by_value, {}),
    (rank.top_agents_by_win_rate, {}),
    (rank.agent_revenue_rank, {}),
    (rank.agent_tier, {}),
    (cumulative.cumulative_deals_by_product, {}),
    (cumulative.threshold_date, {"amount": 500}),
    (cumulative.focal_agent_share, {"agent": "Blake Reed"}),
    (cumulative.new_accounts_by_month, {}),
    (performance.manager_win_rate, {}),
    (performance.sector_performance, {}),
    (performance.negotiation_days, {}),
    (performance.account_win_rate, {}),
    (performance.sector_frequency, {}),
    (segment.agent_segment, {"outlier": "Drew Lane"}),
    (segment.account_segment, {"home": "Homeland"}),
    (report.sales_insights_view, {}),
    (report.agent_month_insights, {}),
]


@pytest.mark.parametrize("fn,kwargs", ALL_OPERATORS, ids=[f.__name__ for f, _ in ALL_OPERATORS])
def test_every_operator_runs_on_name_keyed_model(crm, fn, kwargs):
    df = fn(crm, **kwargs)
    assert df.count() >= 0 and len(df.columns) >= 1


def test_ntile_sizes_and_focal_split(crm):
    sizes = {}
    for _, _, _, t in rows(rank.agent_tier(crm)):
        sizes[t] = sizes.get(t, 0) + 1
    assert max(sizes.values()) - min(sizes.values()) <= 1
    deals = {p: n for p, _, n in rows(explore.magnitude(crm, "product"))}
    for p, f, o, _ in rows(cumulative.focal_agent_share(crm, "Avery Stone")):
        assert f + o == deals[p]


def test_no_won_deals(spark):
    from tests.fixture_crm import frames
    from salescope.sources.crm import model_from_frames

    sales, teams, products, accounts = frames(spark)
    model = model_from_frames(sales.where("deal_stage <> 'Won'"), teams, products, accounts)
    assert rank.agent_tier(model).count() == 0
    assert report.sales_insights_view(model).count() == 0
    assert share.series_share(model).count() == 0
    assert dict(rows(explore.kpi_measures(model)))["qty sold"] == 0.0


def test_kpi_measures_exact_decimal(crm):
    from decimal import Decimal

    got = dict(rows(explore.kpi_measures(crm, value_type="decimal(38,2)")))
    assert got["total sales"] == Decimal("3053.00") and got["deal win %"] == Decimal("85.71")


def test_focal_share_unknown_agent(spark, crm):
    from salescope.sources.star import from_star

    got = rows(cumulative.focal_agent_share(crm, "Nobody Here"))
    assert got and all(f == 0 and pct == 0.0 for _, f, _, pct in got)
    star = from_star(spark, "/root/testdata/sf0.001")  # key-labelled model: empty key set
    got = rows(cumulative.focal_agent_share(star, "Nobody Here"))
    assert got and all(f == 0 for _, f, _, _ in got)
