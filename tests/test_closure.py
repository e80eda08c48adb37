import random

import pytest

from lakesteward.operators.closure import effective_grants, transitive_closure

SCHEMA = "source string, target string"


def _brute(links):
    after = {}
    for a, b in links:
        if a is not None and b is not None:
            after.setdefault(a, set()).add(b)
    out = set()
    for start in after:
        todo, seen = list(after[start]), set()
        while todo:
            node = todo.pop()
            if node not in seen:
                seen.add(node)
                todo += after.get(node, ())
        out |= {(start, node) for node in seen}
    return sorted(out)


def _found(spark, links):
    return sorted(map(tuple, transitive_closure(spark.createDataFrame(links, SCHEMA)).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_links(spark, seed):
    rng = random.Random(seed)
    links = [(f"n{rng.randrange(25)}", f"n{rng.randrange(25)}") for _ in range(35)] + [(None, "n1"), ("n1", None)]
    assert _found(spark, links) == _brute(links)


def test_chain_cycle_and_empty(spark):
    chain = [(f"c{i:02}", f"c{i + 1:02}") for i in range(12)]
    assert _found(spark, chain) == _brute(chain)
    cycle = [("a", "b"), ("b", "c"), ("c", "a"), ("x", "x")]
    assert _found(spark, cycle) == _brute(cycle)
    assert _found(spark, []) == []


def test_plan_does_not_grow_from_round_to_round(spark):
    """What comes back reads files; rounds leave no joins behind."""
    chain = [(f"c{i:02}", f"c{i + 1:02}") for i in range(8)]
    plan = transitive_closure(spark.createDataFrame(chain, SCHEMA))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_privileges_through_roles(spark):
    rows = [
        (1, "'ann'@'%'", "GRANT 'writer' TO USER x"), (2, "writer", "GRANT reader, writer TO ROLE x"), (3, "reader", "GRANT SELECT ON TABLE d.t TO ROLE x"),
        (4, "writer", "GRANT INSERT ON TABLE d.t TO ROLE x"), (5, "'ann'@'%'", "GRANT DROP ON DATABASE d TO USER x"), (6, "'bob'@'h'", "GRANT reader TO USER x"),
        (7, "reader", "GRANT SELECT ON TABLE d.t TO ROLE x"), (8, "reader", "GRANT SELECT ON TABLE nodot TO ROLE x"),
    ]
    grants = spark.createDataFrame([(i, "c", who, sql) for i, who, sql in rows], "grant_id long, catalog string, user_identity string, grant_sql string")
    found = {(r.grantee_name, r.ip, r.object_type, r.permission) for r in effective_grants(grants).collect()}
    assert found == {
        ("ann", "%", "TABLE", "SELECT"), ("ann", "%", "TABLE", "INSERT"), ("ann", "%", "DATABASE", "DROP"), ("bob", "h", "TABLE", "SELECT"),
        ("reader", "", "TABLE", "SELECT"), ("writer", "", "TABLE", "SELECT"), ("writer", "", "TABLE", "INSERT"),
    }
    assert effective_grants(grants.limit(0)).count() == 0


def test_a_role_that_all_have_is_dealt(spark):
    """No task gets all holders of one role; the result is that of the undealt join."""
    users = spark.range(900).selectExpr("id AS grant_id", "'c' AS catalog", "concat('u', id, '@%') AS user_identity", "'GRANT team TO USER x' AS grant_sql")
    roles = spark.createDataFrame(
        [(-1, "c", "team", "GRANT all_staff TO ROLE x"), (-2, "c", "all_staff", "GRANT SELECT, INSERT ON TABLE d.t TO ROLE x")], users.schema
    )
    found = effective_grants(users.unionByName(roles), key_rows=100)
    joins = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line and "target" in line]
    assert any("_salt" in line and "_copy" in line for line in joins)
    rows = [(r.grantee_name, r.permission) for r in found.collect()]
    holders = [f"u{i}" for i in range(900)] + ["team", "all_staff"]
    assert sorted(rows) == sorted((h, p) for h in holders for p in ("SELECT", "INSERT"))
