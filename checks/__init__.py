"""Queries over the given tables, one per operator, with equivalent SQL where SQL can express it."""

from checks import linked, metrics, processors, relational, synthesis

SUITES = [processors.suite, relational.suite, synthesis.suite, metrics.suite, linked.suite]


def flagship(spark, folder):
    return synthesis.a13b(spark, folder)
