"""Report semantics with inline fixtures; every D-n in both modes."""

from helpers import dims, event, events_df

from logloom import schemas
from logloom.plans.report import audit_report


def run(spark, evs, d, **kw):
    kw.setdefault("batch_id", 42)
    kw.setdefault("tenant_name", "T")
    return audit_report(events_df(spark, evs), d, **kw)


def test_columns_are_the_47_report_columns(spark):
    out = run(spark, [event(1)], dims(spark))
    assert out.columns == schemas.REPORT_COLUMNS
    assert len(out.columns) == 47
    types = dict(out.dtypes)
    assert types["BATCH_ID"] == "bigint" and types["SUCCESS"] == "int"
    assert all(t == "string" for c, t in types.items() if c not in ("BATCH_ID", "SUCCESS"))


def test_watermark_edge_d1(spark):
    L = 1_700_000_000_000
    evs = [event(1, L), event(2, L + 1), event(3, L + 2)]
    default = {r.AUDIT_ID for r in run(spark, evs, dims(spark), last_run=L).collect()}
    strict = {r.AUDIT_ID for r in run(spark, evs, dims(spark), last_run=L, strict=True).collect()}
    assert default == {"2", "3"}
    assert strict == {"3"}          # the event at L+1 is never reported by the source


def test_duplicate_user_fans_out_only_in_strict_d4(spark):
    d = dims(spark, users=[("U1", "a", "x"), ("U1", "b", "y")])
    assert run(spark, [event(1)], d).count() == 1
    assert run(spark, [event(1)], d, strict=True).count() == 2


def test_integration_model_name_d5(spark):
    d = dims(spark, models=[("M1", "one"), ("M2", "two")],
             integrations=[("C1", "int1", "M1"), ("C2", "int2", "M2")])
    evs = [event(1, objectId="C1"), event(2, objectId="C2")]
    default = {r.AUDIT_ID: (r.MODEL_ID, r.MODEL_NAME) for r in run(spark, evs, d).collect()}
    assert default == {"1": ("M1", "one"), "2": ("M2", "two")}
    strict = {r.AUDIT_ID: r.MODEL_NAME for r in run(spark, evs, d, strict=True).collect()}
    assert strict == {"1": "one", "2": "one"}   # one constant: the first integration's model


def test_colliding_action_keys_d7(spark):
    d = dims(spark, actions=[("1", "act", "12")])
    evs = [event(1, objectId="2", aa_actionId="11")]
    assert run(spark, evs, d).first().ACTION_NAME == "<Object has been Deleted>"
    assert run(spark, evs, d, strict=True).first().ACTION_NAME == "act"


def test_load_id_nulls_and_wide_index_d8(spark):
    evs = [event(1, eventDate=None, index=None), event(2, eventDate=1_500, index=1_234_567_890),
           event(3, eventDate=-1_500, index=7)]
    got = {r.AUDIT_ID: (r.LOAD_ID, r.EVENT_DATE) for r in run(spark, evs, dims(spark)).collect()}
    assert got["1"] == ("0000000000", None)
    assert got["2"] == ("11234567890", "1970-01-01 00:00:01")   # never cut to 9 digits
    assert got["3"][0] == "-1000000007"                          # -1500 div 1000 = -1


def test_object_type_priority_and_action_names(spark):
    d = dims(spark, users=[("X1", "user", "d")], models=[("X1", "model")],
             integrations=[("X1", "integration", "M9")], actions=[("5", "named", "X1")])
    evs = [event(1, objectId="X1", aa_actionId="5"), event(2, objectId="X1", aa_actionId="-1"),
           event(3, objectId="nope", aa_actionId="7"), event(4, objectId="nope")]
    got = {r.AUDIT_ID: (r.OBJECT_TYPE, r.OBJECT_NAME, r.ACTION_NAME) for r in run(spark, evs, d).collect()}
    assert got["1"] == ("Model", "model", "named")
    assert got["2"] == ("Model", "model", "Unsaved Action")
    assert got["3"] == (None, None, "<Object has been Deleted>")
    assert got["4"] == (None, None, None)


def test_activity_code_and_attribute_model(spark):
    d = dims(spark, models=[("M1", "one")], act_codes=[("t", "msg", "--", None)])
    evs = [event(1, aa_modelId="M1"), event(2, aa_modelId="M404")]
    got = {r.AUDIT_ID: (r.EVENT_MESSAGE, r.ASSOCIATED_OBJECT_ID, r.NOTES, r.MODEL_ID, r.MODEL_NAME)
           for r in run(spark, evs, d).collect()}
    assert got["1"] == ("msg", "--", None, "M1", "one")
    assert got["2"] == ("msg", "--", None, "M404", None)   # unmatched attribute model: null name
