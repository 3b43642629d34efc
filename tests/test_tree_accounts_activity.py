from dataclasses import replace
from datetime import date

from leadlift.config import RunConfig
from leadlift.operators.accounts import account_parents, eligible_accounts, one_parent
from leadlift.operators.activity import (
    activity_lines,
    consulting_lines,
    created_since,
    line_profile,
    node_profile,
    recent_lines,
)
from leadlift.operators.candidates import buyers_by_node, candidate_products, stalest_products
from leadlift.operators.features import align, feature_rows, labels_by_period, wide
from leadlift.operators.hierarchy import branch_nodes, combine_levels, full_paths, level_map, tree_nodes
from leadlift.sources.readers import product_tree
from leadlift.sources.schemas import ACCOUNT_DIM, ACCOUNT_MASTER, ACCOUNT_ROLE, PRODUCT_TREE

CFG = RunConfig(as_of=date(2024, 8, 15))
LINE = "account_id string, opportunity_id string, product_id string, item_type string, status string, status_ymd int, status_date date, created_ts14 long"


def make_tree(spark, paths):
    data = [
        (f"000{i}", f"leaf {i}", *[x for c in path for x in (c, f"text {c}")])
        for i, path in enumerate(paths, 1)
    ]
    return product_tree(spark.createDataFrame(data, PRODUCT_TREE))


def lines(spark, *items):
    """(account, opportunity, product, item type, status, yyyymmdd) as lines."""
    data = [
        (a, o, p, t, s, ymd, date(ymd // 10000, ymd // 100 % 100, ymd % 100), ymd * 1000000)
        for a, o, p, t, s, ymd in items
    ]
    return spark.createDataFrame(data, LINE)


def known(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "account_id string")


def test_tree_forms(spark, rows):
    tree = make_tree(
        spark,
        [("a", "b", "c", "d", "e", "f"), ("a", "b", "c", "d", "e", "g"), ("a", "b", "x", "d", "e", ""),
         ("a", "b", "c", "d", "e", None)],
    )
    assert {r["product_id"] for r in tree.collect()} == {"1", "2", "3", "4"}
    assert tree_nodes(tree).count() == 24
    assert rows(tree_nodes(tree, ("LEVEL6",)), "product_id", "node_code", "level") == sorted(
        [("1", "f", "LEVEL6"), ("2", "g", "LEVEL6"), ("3", "", "LEVEL6"), ("4", None, "LEVEL6")], key=lambda t: tuple(map(repr, t))
    )
    assert tree_nodes(tree, ("LEVEL7",)).count() == 0
    paths = full_paths(tree)
    assert paths.count() == 2
    # One row per path and leaf, so the shared level-5 code appears twice...
    assert combine_levels(paths).filter("l5_or_l6 = 'e'").count() == 2
    # ... and once in the map.
    assert rows(level_map(paths)) == [("e", "c"), ("f", "c"), ("g", "c")]


def test_a_code_may_have_several_parents(spark, rows):
    tree = make_tree(spark, [("a", "b", "c1", "d", "e", "f"), ("a", "b", "c2", "d", "e", "g")])
    assert [r for r in rows(level_map(full_paths(tree))) if r[0] == "e"] == [("e", "c1"), ("e", "c2")]


def test_branch_nodes_follow_paths_both_ways(spark, rows):
    tree = make_tree(spark, [("a", "b", "c", "d", "e", "f"), ("a", "b2", "c2", "d2", "e2", "f2")])
    wanted = spark.createDataFrame([("e",), ("a",), ("f2",)], "product_code string")
    assert rows(branch_nodes(tree, wanted, "LEVEL6"), "product_code", "node_code") == [
        ("a", "f"), ("a", "f2"), ("e", "f"), ("f2", "f2"),
    ]


def test_eligibility_rules(spark):
    good = ("1", "m", "i", "s", "02", "Y", "C", "B", "E0004", "", "", "", "")

    def changed(key, **new):
        row = dict(zip(ACCOUNT_MASTER.fieldNames(), good), account_id=key, **new)
        return tuple(row[n] for n in ACCOUNT_MASTER.fieldNames())

    master = spark.createDataFrame(
        [
            good, good, changed("blank segment", internal_segment=""), changed("01", internal_segment="01"),
            changed("kind", partner_kind="U"), changed("null kind", partner_kind=None),
            changed("deleted", deleted="X"), changed("blocked", blocked="X"),
            changed("released", not_released="X"), changed("null flag", deleted=None),
            changed("no role"), changed("only excluded"), changed("two roles"), changed(""),
        ],
        ACCOUNT_MASTER,
    )
    ids = [r["account_id"] for r in master.collect() if r["account_id"] not in ("no role", "only excluded")]
    roles = spark.createDataFrame(
        [(i, "BUP001") for i in ids] + [("only excluded", "BUP004"), ("two roles", "BUP004"), ("null", None)],
        ACCOUNT_ROLE,
    )
    got = eligible_accounts(master, roles)
    assert sorted(r["account_id"] for r in got.collect()) == ["1", "two roles"]
    dim = spark.createDataFrame([("1", "", "N/R")], ACCOUNT_DIM)
    segments = {r["account_id"]: r["market_segment"] for r in eligible_accounts(master, roles, dim).collect()}
    assert segments == {"1": "N/R", "two roles": None}


def test_parent_falls_back_to_the_account(spark, rows):
    dim = spark.createDataFrame([(" 1 ", "", None), ("2", " p ", None), ("3", None, None), ("2", "q", None)], ACCOUNT_DIM)
    assert (" 1 ", " 1 ") in rows(account_parents(dim))
    assert (" 1 ", "1") in rows(account_parents(dim, trimmed=True))
    assert ("2", "p") in rows(account_parents(dim, trimmed=True))
    assert one_parent(account_parents(dim)).count() == 3


def test_lines_are_cut_by_status_and_creation_date(spark):
    df = lines(spark, ("1", "o", "1", "x", "E0003", 20210415), ("1", "o", "1", "x", "E0003", 20210416))
    assert [r["status_ymd"] for r in recent_lines(df, CFG.as_of).collect()] == [20210416]
    df = lines(spark, ("1", "o", "1", "x", "E0003", 20220101), ("1", "o", "1", "x", "E0003", 20220102))
    assert [r["status_ymd"] for r in created_since(df, CFG.as_of, 30).collect()] == [20220102]


def test_activity_lines_drop_blank_nodes_and_unknown_accounts(spark, rows):
    tree = make_tree(spark, [("a", " ", "c", "d", "e", "")])
    df = lines(spark, ("1", "o", "1", "x", "E0003", 20240101), ("2", "o", "1", "x", "E0003", 20240101))
    got = activity_lines(df, tree_nodes(tree), known(spark, "1", "9"))
    assert rows(got, "account_id", "node_code") == [("1", "a"), ("1", "c"), ("1", "d"), ("1", "e")]


def test_consulting_lines_keep_whole_opportunities(spark, rows):
    df = lines(
        spark, ("1", "o1", "1", "CONS", "E0003", 20240101), ("1", "o1", "2", "x", "E0003", 20240101),
        ("1", "o1", "3", "EDU", "E0003", 20240101), ("1", "o2", "1", "x", "E0003", 20240101),
    )
    got = consulting_lines(df, df, CFG.consulting_item_types)
    assert rows(got, "opportunity_id", "product_id") == [("o1", "1"), ("o1", "2"), ("o1", "3")]


def test_one_pass_profile_equals_one_filter_per_period(spark, rows):
    """Labels and features against a plain loop over periods."""
    from leadlift.functions.periods import period_bounds

    items = []
    for i in range(400):
        ymd = (2021 + i % 4) * 10000 + (i * 7 % 12 + 1) * 100 + i % 28 + 1
        status = ("E0001", "E0003", "E0004", "E0007", "E0002")[i % 5]
        items.append((str(i % 7), f"o{i}", str(i % 3 + 1), "x", status, ymd))
    df = lines(spark, *items)
    tree = make_tree(spark, [("a", "b", "c", "d", "e", f"f{i // 2}") for i in range(3)])
    nodes = tree_nodes(tree, ("LEVEL6",))
    accounts = known(spark, *map(str, range(6)))
    profile = node_profile(line_profile(df, CFG), nodes, accounts)

    leaf = {"1": "f0", "2": "f0", "3": "f1"}
    seen = [(a, leaf[p], s, ymd) for a, _, p, _, s, ymd in items if a != "6"]

    def count(kind, statuses):
        out = {}
        for w in period_bounds(CFG.as_of, kind):
            for a, n, s, ymd in seen:
                if s in statuses and w.lo <= ymd < w.hi:
                    out[a, n, w.period] = out.get((a, n, w.period), 0) + 1
        return out

    labels = {(r["account_id"], r["node_code"], r["period"]): r["count"] for r in labels_by_period(profile).collect()}
    assert labels == count("label", CFG.won_statuses) and labels
    got = {(r["account_id"], r["feature"], r["period"]): r["value"] for r in feature_rows(profile, CFG).collect()}
    want = {(a, "open_quarter_" + n, p): v for (a, n, p), v in count("quarter", CFG.open_statuses).items()}
    want |= {(a, "open_year_" + n, p): v for (a, n, p), v in count("year", CFG.open_statuses).items()}
    for w in period_bounds(CFG.as_of, "first"):
        for a, n, s, ymd in seen:
            if s in CFG.open_statuses and ymd < w.hi:
                day = date(ymd // 10000, ymd // 100 % 100, ymd % 100)
                key = (a, "first_open_" + n, w.period)
                want[key] = max(want.get(key, 0), (w.hi_date - day).days)
    assert got == want

    served = node_profile(line_profile(df, CFG, periods=1, serving=True), nodes, accounts)
    quarter = {
        (r["account_id"], r["feature"]): r["value"]
        for r in feature_rows(served, CFG).collect() if r["feature"].startswith("open_quarter")
    }
    everything = {}
    for a, n, s, _ in seen:
        if s in CFG.open_statuses:
            everything[a, "open_quarter_" + n] = everything.get((a, "open_quarter_" + n), 0) + 1
    assert quarter == everything


def test_first_open_statuses_are_a_parameter(spark, rows):
    df = lines(spark, ("1", "o", "1", "x", "E0003", 20240101), ("1", "o", "1", "x", "E0001", 20240201))
    won = replace(CFG, first_open_statuses=CFG.won_statuses)
    got = {r["product_id"]: r["first_open_1"] for r in line_profile(df, won, ("first_open",)).collect()}
    assert got == {"1": date(2024, 1, 1)}


def test_candidates_need_fifty_buyers(spark, rows):
    tree = make_tree(spark, [("a", "b", "c", "d", "e", "many"), ("a", "b", "c", "d", "e", "few")])
    items = [(str(i), f"o{i}", "1", "x", "E0003", 20240101) for i in range(50)]
    items += [(str(i), f"o{i}", "2", "x", "E0004", 20240101) for i in range(49)]
    items += [("0", "again", "2", "x", "E0004", 20240101), ("60", "o", "2", "x", "E0001", 20240101)]
    accounts = known(spark, *map(str, range(61)))
    buyers = buyers_by_node(lines(spark, *items), tree_nodes(tree), accounts, CFG)
    assert rows(buyers.filter("level = 'LEVEL6'"), "node_code", "buyers") == [("many", 50)]
    assert [tuple(r) for r in candidate_products(buyers, CFG).collect()] == [("many", "LEVEL6", 50)]
    consulting = candidate_products(buyers, replace(CFG, model_type="consulting"))
    assert [tuple(r) for r in consulting.collect()] == [
        ("d", "LEVEL4", 50), ("e", "LEVEL5", 50), ("many", "LEVEL6", 50)
    ]


def test_candidates_are_neither_capped_nor_named_twice(spark):
    data = [(f"n{i:04d}", "LEVEL6", 60) for i in range(1200)] + [("n0000", "LEVEL7", 90), ("n0001", "LEVEL5", 99)]
    got = candidate_products(spark.createDataFrame(data, "node_code string, level string, buyers long"), CFG).collect()
    assert len(got) == 1200
    assert {r["level"] for r in got} == {"LEVEL6"}


def test_stalest_products_come_once(spark, rows):
    df = spark.createDataFrame(
        [("b.2024", "20240101"), ("b.2024", "20240201"), ("a.2024", "20240103"), ("c.2023", "20200101")],
        "product_code string, score_date string",
    )
    got = [tuple(r) for r in stalest_products(df, "2024", 50).collect()]
    assert got == [("b.2024", "20240101"), ("a.2024", "20240103")]


def test_wide_and_align(spark, rows):
    df = spark.createDataFrame(
        [("1", "x", 1, 5), ("1", "y", 1, 2), ("2", "x", 1, 1)],
        "account_id string, feature string, period int, value long",
    )
    block = wide(df, ["account_id"], ["x", "y"])
    assert rows(block, "account_id", "x", "y") == [("1", 5, 2), ("2", 1, None)]
    assert rows(align(block, ["y", "new"], ["account_id"])) == [("1", 2.0, 0.0), ("2", 0.0, 0.0)]


def test_the_roll_up_shuffles_by_account_once(spark, rows):
    profile = spark.createDataFrame(
        [("1", "p", 2, date(2024, 1, 2)), ("1", "q", 3, date(2024, 1, 1)), ("9", "p", 5, None), (None, "p", 1, None)],
        "account_id string, product_id string, open_year_1 long, first_open_1 date",
    )
    nodes = spark.createDataFrame(
        [("p", "N", "t", "LEVEL2"), ("q", "N", "t", "LEVEL2"), ("q", " ", "t", "LEVEL3")],
        "product_id string, node_code string, node_text string, level string",
    )
    known = spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "account_id string")
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = node_profile(profile, nodes, known)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert rows(got) == [("1", "LEVEL2", "N", 5, date(2024, 1, 1))]
        # The roll-up's and that of the accounts; the others are by product.
        assert plan.count("Exchange hashpartitioning(account_id") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
