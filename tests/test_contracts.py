"""Audits, migrations and deletes on small tables with planted violations."""

import pytest

from folioflow.operators import contracts as G
from folioflow.schemas import CONTRACTS, MIGRATION, migrated


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_contract_counts():
    """As many constraints as the schema declares."""
    tables = CONTRACTS.values()
    assert len(tables) == 17
    assert sum(len(t.foreign_keys) for t in tables) == 18
    actions = [fk.on_delete for t in tables for fk in t.foreign_keys]
    assert (actions.count("cascade"), actions.count("set_null"), actions.count("restrict")) == (15, 2, 1)
    assert sum(len(t.unique) for t in tables) == 3
    assert sum(len(t.defaults) for t in tables) == 29
    assert sum(len(t.decimals) for t in tables) == 3
    assert all(set(t.primary_key) <= set(t.required) for t in tables)


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None), (3, None)], "id int, u string")
    assert rows(G.primary_key_violations(df, ["id"])) == [(1, 2), (None, 1)]
    assert rows(G.unique_violations(df, ["u"])) == []
    assert rows(G.unique_violations(df.union(df), ["u"])) == [("a", 2), ("b", 2), ("c", 2)]
    assert rows(G.primary_key_violations(df, ["id", "u"])) == [(2, None, 1), (3, None, 1), (None, "c", 1)]


def test_orphans_are_counted_per_key(spark):
    child = spark.createDataFrame([(1,)] * 50 + [(2,), (None,), (9,), (9,)], "p int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(G.orphans(child, "p", parent, "id")) == [(9, 2)]


def test_sizes(spark):
    df = spark.createDataFrame([("🙂🙂🙂", 9.99994), ("ab", 9.99996), (None, -10.0), ("", None), ("x", 1e9)],
                               "s string, d double")
    assert rows(G.length_audit(df, {"s": 2})) == [("s", 3, 1)]
    assert rows(G.decimal_audit(df, {"d": (5, 4)})) == [("d", 3)]
    assert rows(G.null_audit(df, ["s", "d"])) == [("d", 1), ("s", 1)]


def test_migration_adds_only_what_is_missing(spark):
    df = spark.createDataFrame([(1, 5)], "id int, retry_count int")
    out = G.add_columns(df, MIGRATION)
    assert out.columns == ["id", "retry_count", "processing_notes"]
    assert rows(out) == [(1, 5, "")]
    assert rows(G.add_columns(out, MIGRATION)) == [(1, 5, "")]
    assert rows(G.required_columns(df, ["retry_count", "processing_notes"])) == [
        ("processing_notes", False, 0), ("retry_count", True, 1)]


def test_listing(spark):
    df = spark.createDataFrame([(1, None)], "status int, id int")
    listing = G.schema_listing(df, migrated(CONTRACTS["documents"]))
    assert [tuple(r) for r in listing.collect()] == [
        ("id", "int", False, None, 1), ("status", "int", False, "'Uploaded'", 0)]


@pytest.fixture
def tables(spark):
    def make(schema, *data):
        return spark.createDataFrame(list(data), schema)

    return {
        "asp_net_users": make("id string", ("u1",), ("u2",), ("u3",)),
        "asp_net_user_roles": make("user_id string, role_id string", ("u1", "r"), ("u2", "r"), ("u3", "r")),
        "a_i_configurations": make("id int, user_id string", (1, "u1"), (2, "u2"), (4, None)),
        "a_i_provider_configs": make("id int, a_i_configuration_id int", (10, 1), (20, 2), (21, 2)),
        "documents": make("id int, uploaded_by_user_id string", (1, "u3"), (2, "u3"), (3, None)),
        "document_chunks": make("id int, document_id int", (1, 1), (2, 1), (3, 2), (4, 3)),
        "chat_sessions": make("id int, user_id string, document_id int", (1, "u1", 1), (2, "u3", 1), (3, None, 2)),
        "chat_messages": make("id int, chat_session_id int, document_id int", (1, 1, 1), (2, 2, 1), (3, 3, 2)),
    }


def test_deleting_users(spark, tables):
    ids = spark.createDataFrame([("u1",), ("u2",), ("u3",), ("u9",), ("u1",)], "id string")
    after, blocked = G.delete_rows(tables, "asp_net_users", ids)
    assert rows(blocked) == [("u3",)]
    assert rows(after["asp_net_users"]) == [("u3",)]
    assert rows(after["asp_net_user_roles"]) == [("u3", "r")]
    assert rows(after["a_i_configurations"].select("id")) == [(4,)]
    assert rows(after["a_i_provider_configs"]) == []
    assert rows(after["chat_sessions"].select("id")) == [(2,), (3,)]
    assert rows(after["chat_messages"].select("id")) == [(2,), (3,)]
    assert rows(after["documents"].select("id")) == [(1,), (2,), (3,)]


def test_deleting_documents(spark, tables):
    after, blocked = G.delete_rows(tables, "documents", spark.createDataFrame([(1,)], "id int"))
    assert rows(blocked) == []
    assert rows(after["documents"].select("id")) == [(2,), (3,)]
    assert rows(after["document_chunks"]) == [(3, 2), (4, 3)]
    assert rows(after["chat_sessions"]) == [(1, "u1", None), (2, "u3", None), (3, None, 2)]
    assert rows(after["chat_messages"]) == [(1, 1, None), (2, 2, None), (3, 3, 2)]


def test_whole_audit(tables):
    found = G.audit("documents", {**tables, "documents": tables["documents"].selectExpr(
        "id", "uploaded_by_user_id", *[f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}"
                                       for f in CONTRACTS["documents"].schema
                                       if f.name not in ("id", "uploaded_by_user_id")])})
    assert set(found) == {"primary_key", "not_null", "foreign_key:uploaded_by_user_id", "length"}
    nulls = {r["column"]: r.n_null for r in found["not_null"].collect()}
    assert nulls["id"] == 0 and nulls["status"] == 3


def test_schema_facts_need_no_rows(spark):
    from folioflow.operators.contracts import required_columns, schema_listing

    none = spark.createDataFrame([], "a int, b string")
    assert [(r.column, r.data_type, r.is_nullable, r.n_null) for r in schema_listing(none).collect()] == [
        ("a", "int", True, 0), ("b", "string", True, 0)]
    assert [(r.column, r.present, r.n_filled) for r in required_columns(none, ["a", "c"]).collect()] == [("a", True, 0), ("c", False, 0)]
