"""Rules as tables agree with the same rules as literals, and no rule meets every row."""

import random

from pyspark.sql import functions as F

from playbill.functions import tokens as K
from playbill.operators import classify, rule_tables


def test_classify_by_table_agrees_with_literals(spark):
    rng = random.Random(1)
    letters = "abcdé漢 -"
    rules = [(n, f"T{n}", None if n % 3 else f"C{n}", ["".join(rng.choices(letters, k=rng.randrange(1, 6))) for _ in range(3)]) for n in range(40)]
    titles = ["".join(rng.choices(letters + "ABCÉ", k=rng.randrange(0, 12))) for _ in range(400)] + [None, "", "ab"]
    kinds = "rule_no int, type_eng string, type_chi string, keyword string"
    table = spark.createDataFrame([(n, e, c, word) for n, e, c, words in rules for word in words] + [(99, "x", "x", ""), (98, "x", "x", None)], kinds)
    rows = spark.createDataFrame([(t,) for t in titles], "title string")
    literals = [classify.TypeRule(e, c, tuple(words)) for _, e, c, words in rules]
    expected = {r.title: r.kind for r in rows.select("title", classify.classify(F.col("title"), literals).alias("kind")).collect() if r.kind}
    found = rule_tables.classify_by_table(rows, table).collect()
    assert {r.title: r.type_eng for r in found} == expected and len(found) == len(expected) > 100
    assert all(r.type_chi == (None if int(r.type_eng[1:]) % 3 else "C" + r.type_eng[1:]) for r in found)
    assert rule_tables.classify_by_table(rows, table.where("rule_no > 97")).count() == 0
    assert rule_tables.classify_by_table(rows.limit(0), table).count() == 0


def test_many_rules_without_a_nested_loop(spark):
    """10^5 rules, 20,000 titles of which one makes up a third."""
    rules = spark.range(100_000).selectExpr("id AS rule_no", "concat('t', id) AS type_eng", "'x' AS type_chi", "concat('k', lpad(cast(id AS string), 6, '0'), 'z') AS keyword")
    titles = spark.range(20_000).selectExpr("if(id % 3 = 0, 'Night of K000042Z', concat('Show K', lpad(cast(id * 7 AS string), 6, '0'), 'Z')) AS title")
    found = rule_tables.classify_by_table(titles, rules)
    rows = {r.title: r.type_eng for r in found.collect()}
    assert rows["Night of K000042Z"] == "t42"
    assert len(rows) == 1 + sum(1 for i in range(20_000) if i % 3 and i * 7 < 100_000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_labels_by_table_agree_with_literals(spark):
    rng = random.Random(2)
    words = ["Date", "date", "VENUE", "fee", "when", "x", "y", "z", ""]
    rows = [(i, rng.choice(["p", "q"]), rng.choices(words, k=rng.randrange(0, 9))) for i in range(300)] + [(300, None, ["date", "x"]), (301, "p", None)]
    rules = [("p", "date_text", "date", 1), ("p", "date_text", "when", 2), ("p", "fee", "fee", 1), ("q", "fee", "venue", 1), ("q", "fee", "fee", 2)]
    df = spark.createDataFrame(rows, "id int, source string, tokens array<string>")
    found = rule_tables.labels_by_table(df, spark.createDataFrame(rules, "source string, field string, alias string, rank int"), ("id",))
    expected = set()
    for source, field in {r[:2] for r in rules}:
        aliases = [r[2] for r in rules if r[:2] == (source, field)]
        value = K.after_label(F.col("tokens"), K.lower_tokens(F.col("tokens")), *aliases)
        expected |= {(r.id, field, r.v) for r in df.where(F.col("source") == source).select("id", value.alias("v")).collect() if r.v is not None}
    assert {tuple(r) for r in found.collect()} == expected and len(expected) > 100


def _told(rows, rules):
    """What the rows tell by name: the first place of a label in all rows of a name counts."""
    first = {}
    for name, source, tokens in rows:
        for at, token in enumerate(tokens or ()):
            for of, field, alias, rank in rules:
                if of == source and token is not None and token.lower() == alias:
                    value = tokens[at + 1] if at + 1 < len(tokens) else None
                    key = (name, field, alias, rank)
                    first[key] = min(first.get(key, (at, value)), (at, value), key=lambda hit: (hit[0], hit[1] is not None, hit[1] or ""))
    best = {}
    for (name, field, alias, rank), (_, value) in first.items():
        if value is not None:
            best[name, field] = max(best.get((name, field), ((rank, alias), value)), ((rank, alias), value))
    return {(name, field, value) for (name, field), (_, value) in best.items()}


def test_labels_by_table_of_repeated_names_and_null_tokens(spark):
    """Rows of one name are told together, NULL is a name, and a NULL token behind a label hides it."""
    rng = random.Random(3)
    words = ["a", "A", "b", "c", "d", "x", "y", None, ""]
    rules = [(s, f, a, r) for s, f, a, r in [("p", "f", "a", 1), ("p", "f", "b", 2), ("p", "g", "b", 1), ("p", "f", "a", 3), ("q", "f", "c", 1), ("q", "g", "a", 2), ("q", "g", "d", 2)]]
    table = spark.createDataFrame(rules, "source string, field string, alias string, rank int")
    for names in (400, 60, 1):  # hardly any name is repeated, most are, all are
        rows = [(rng.choice([None, *range(names)]) if names < 400 else n, rng.choice("pq"), rng.choices(words, k=rng.randrange(0, 9))) for n in range(400)]
        found = rule_tables.labels_by_table(spark.createDataFrame(rows, "id int, source string, tokens array<string>"), table, ("id",)).collect()
        assert {tuple(r) for r in found} == _told(rows, rules) and len(found) == len({r[:2] for r in found})


def test_labels_of_single_rows_stay_in_their_task(spark):
    """Only what a row tells is shuffled, not its hits of every label."""
    tokens = [f"l{k % 40}" for k in range(200)]
    rules = spark.createDataFrame([("p", "f", f"l{k}", k) for k in range(40)], "source string, field string, alias string, rank int")
    rows = spark.createDataFrame([(n, "p", tokens) for n in range(50)], "id int, source string, tokens array<string>")
    found = rule_tables.labels_by_table(rows, rules, ("id",))
    assert {tuple(r) for r in found.collect()} == {(n, "f", "l0") for n in range(50)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.split("\n") if "Exchange hashpartitioning(id#" in line]
    assert dealt and not any("_alias" in line for line in dealt)
