from helpers import df

from logloom.operators import dimensions as D
from logloom.operators import lookups as LK


def test_active_models_keeps_null_state_d10(spark):
    m = df(spark, ["id", "activeState"], [("a", "ARCHIVED"), ("b", None), ("c", "UNLOCKED")])
    assert sorted(r.id for r in D.active_models(m).collect()) == ["b", "c"]


def test_absent_column_is_tolerated_d12(spark):
    m = df(spark, ["id", "name"], [("a", "x")])
    assert D.dim_models(m).columns == ["id", "name"]
    cw = df(spark, ["integrationId", "name"], [("c", "n")])
    assert D.dim_integrations(cw).count() == 1


def test_unique_on_picks_one_row_and_keeps_null_keys(spark):
    d = df(spark, ["id", "v"], [("a", "1"), ("a", "2"), (None, "3"), (None, "4")])
    out = {(r.id, r.v) for r in D.unique_on(d, ["id"]).collect()}
    assert out == {("a", "2"), (None, "3"), (None, "4")}
    assert D.unique_on(d, ["id"], keep_null_keys=False).count() == 1


def test_scope_skip_and_select(spark):
    models = df(spark, ["id", "currentWorkspaceId"], [("M1", "W1"), ("M2", "W1"), ("M3", "W2")])
    combos = df(spark, ["WorkspaceId", "ModelId"], [("W1", "M1"), ("W1", "M1"), ("W9", "M3")])
    assert sorted(r.id for r in D.scope_skip(models, combos).collect()) == ["M2", "M3"]
    sel = D.scope_select(models, combos, target_model="M3")
    assert sorted(r.id for r in sel.collect()) == ["M1", "M3"]
    assert D.apply_scope(models, "other", combos).count() == 3


def test_crawl_worklist_counts_pages(spark):
    models = df(spark, ["id", "currentWorkspaceId"], [("M1", "W1")])
    got = df(spark, ["workspace_id", "model_id", "kind"], [("W1", "M1", "files"), ("W1", "M1", "files")])
    out = {r.kind: r.n_received for r in D.crawl_worklist(models, got).collect()}
    assert out == {"imports": 0, "exports": 0, "actions": 0, "processes": 0, "files": 2}


def test_resolve_ids_first_match_and_missing(spark):
    ws = df(spark, ["id", "name"], [("w2", "Main"), ("w1", "Main")])
    models = df(spark, ["id", "currentWorkspaceId", "name"], [("m1", "w1", "Plan")])
    empty = df(spark, ["id", "workspace_id", "model_id", "name"], [])
    req = df(spark, ["kind", "workspace_id", "model_id", "name"],
             [("workspace", None, None, "Main"), ("workspace", None, None, "Nope"),
              ("model", "w1", None, "Plan"), ("model", "w2", None, "Plan")])
    out = {(r.kind, r.workspace_id, r.name): r.resolved_id
           for r in LK.resolve_ids(req, ws, models, empty, empty).collect()}
    assert out == {("workspace", None, "Main"): "w1", ("workspace", None, "Nope"): "-1",
                   ("model", "w1", "Plan"): "m1", ("model", "w2", "Plan"): "-1"}


def test_resolve_names_by_id_and_composite_key(spark):
    ws = df(spark, ["id", "name"], [("w1", "Main")])
    models = df(spark, ["id", "name"], [("m1", "Plan"), ("m2", None)])
    actions = df(spark, ["id", "name", "workspace_id", "model_id"], [("5", "load", "w1", "m1")])
    req = df(spark, ["kind", "workspace_id", "model_id", "id"],
             [("workspace", None, None, "w1"), ("workspace", None, None, "w9"),
              ("model", None, None, "m2"), ("action", "w1", "m1", "5"), ("action", "w1", "m2", "5")])
    out = {(r.kind, r.model_id, r.id): r.resolved_name
           for r in LK.resolve_names(req, ws, models, actions).collect()}
    assert out == {("workspace", None, "w1"): "Main", ("workspace", None, "w9"): "-1",
                   ("model", None, "m2"): None,             # found, name null: the null is returned
                   ("action", "m1", "5"): "load", ("action", "m2", "5"): "-1"}
