"""Parts of a narrative in as few groupings as it needs."""

from test_figure_plans import _code, plan_of

from quarrylens.plans import code as c


def test_case_expressions_are_counted_without_a_second_grouping(spark):
    """narratives: complexity counts the statements that hold a CASE expression as it counts the rest."""
    code = _code(spark, "CREATE OR REPLACE PROCEDURE p(a NUMBER) IS\nBEGIN\n  v := CASE WHEN a < 3 THEN 1 ELSE 2 END + CASE a WHEN 1 THEN 5 END;\n  w := CASE a WHEN 2 THEN 1 END;\nEND p;\n/")
    found = c.complexity(code)
    assert found.first().structural == 2 and plan_of(found).count("Exchange hashpartitioning") == 3
