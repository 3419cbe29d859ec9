"""Small corpora and fixture files for the tests (a module of its own: no test imports a conftest)."""

import os

from lodestar.schemas import CORPUS

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


def make_corpus(spark, docs):
    """docs: list of (doc_id, text) or (doc_id, title, byline, text, headline)."""
    rows = []
    for d in docs:
        if len(d) == 2:
            doc_id, text = d
            title = byline = None
            headline = (text or "")[:60]
        else:
            doc_id, title, byline, text, headline = d
        rows.append((doc_id, None, title, headline, byline, None, text, [], [], []))
    return spark.createDataFrame(rows, CORPUS)


def scanned_rows(df):
    """Rows that the file scans of ``df`` gave out, from the metrics of the plan that ran."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    total, stack = 0, [plan]
    while stack:
        p = stack.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            stack.append(p.plan())
        elif name == "ReusedExchangeExec":
            continue
        elif name == "FileSourceScanExec":
            total += p.metrics().apply("numOutputRows").value()
        else:
            children = p.children()
            stack.extend(children.apply(i) for i in range(children.size()))
    return total


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()
