"""What a call means, held against all routines tried one by one, and slices against the source."""

import pytest

from quarrylens.plans import code as c

BODIES = {
    ("U", "K1"): ["LOG", "RUN"],
    ("U", "K2"): ["LOG"],
    ("W", "K3"): ["LOG", "RUN"],
}
ALONE = [("U", "FREE"), ("X", "FREE"), ("", "FREE"), ("X", "LOG")]
CALLS = ["log", "k2.log", "u.free", "free", "x.free", "nope", "k3.log", "w.k3.log", "k1.run", "run", "x.log", "u.log"]


def _body():
    return "\n".join(f"{name}(1);" for name in CALLS)


def _files():
    out = []
    for (owner, package), members in BODIES.items():
        inner = "\n".join(f"PROCEDURE {m} IS BEGIN\n{_body()}\nEND {m};" for m in members)
        out.append((f"{owner}_{package}.sql", f"CREATE OR REPLACE PACKAGE BODY {owner}.{package} IS\n{inner}\nEND {package};\n/"))
    for owner, name in ALONE:
        shown = f"{owner}.{name}" if owner else name
        out.append((f"{owner}_{name}.sql", f"CREATE OR REPLACE PROCEDURE {shown} IS BEGIN\n{_body()}\nEND;\n/"))
    return out


def _meant(caller, call, objects):
    """The least routine of the best rank, by trying every one."""
    parts = call.upper().split(".")
    last, qualifier = parts[-1], parts[-2] if len(parts) > 1 else None
    found = []
    for o in objects:
        if (o.member or o.name) != last:
            continue
        same_owner = caller.owner is not None and caller.owner == o.owner
        if o.member and qualifier is None:
            if o.name == caller.name and same_owner:
                found.append((1, o.object_id))
        elif (o.member and qualifier == o.name) or (not o.member and qualifier in (None, o.owner)):
            found.append((2 if same_owner else 3, o.object_id))
    return min(found)[1] if found else None


@pytest.fixture(scope="module")
def base(spark):
    return c.Code(spark.createDataFrame(_files(), "file string, text string"))


def test_calls_mean_the_nearest_routine(base):
    objects = base.rows("objects").filter("type IN ('PROCEDURE', 'FUNCTION')").collect()
    callers = {o.object_id: o for o in objects}
    rows = c.calls(base).filter("call_target <> 'RAISE_APPLICATION_ERROR'").collect()
    assert len(rows) == len(CALLS) * len(objects) == len({r.statement_id for r in rows})
    for r in rows:
        assert r.call_target_object_id == _meant(callers[r.object_id], r.call_target, objects), (r.object_id, r.call_target)


def test_slices_stay_in_their_object(spark):
    text = "CREATE OR REPLACE PROCEDURE {n} (p IN NUMBER) IS\n a NUMBER; b NUMBER;\nBEGIN\n a := p + 1;\n IF a > 0 THEN\n  b := a * 2;\n END IF;\nEND;\n/\n"
    files = [("two.sql", text.format(n="one") + text.format(n="two")), ("empty.sql", ""), ("none.sql", None)]
    rows = c.slices(c.Code(spark.createDataFrame(files, "file string, text string"))).collect()
    assert {(r.object_id, r.variable, tuple(r.determined_by), tuple(r.depends_on_variables)) for r in rows} == {
        (o, v, d, x) for o in ("PROC-.ONE", "PROC-.TWO") for v, d, x in (("A", (1,), ("P",)), ("B", (1, 2, 3), ("A", "P")))
    }
