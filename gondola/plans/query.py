"""SQL text over given frames, for callers that must not reach anything else.

Spark's own parser reads the text; what it may touch is decided on the parsed tree: every
relation is one of the given tables or a name of the statement's own WITH clause, and
functions that call into the JVM are refused. The statement then runs in a session of its
own, where only the given tables are views, so no view of the caller is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREVIEW_ROWS = 50
NAMESPACE = "lake"

FORBIDDEN_FUNCTIONS = frozenset({"reflect", "try_reflect", "java_method"})


def _items(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _nodes(node) -> Iterator:
    """A parsed plan or expression and all below it: children, WITH clauses, subqueries."""
    yield node
    below = [*_items(node.children()), *_items(node.innerChildren())]
    types = {c.getName().rsplit(".", 1)[-1] for c in _supertypes(node.getClass())}
    if "QueryPlan" in types:
        below += _items(node.expressions())
    if "PlanExpression" in types:
        below.append(node.plan())
    for child in below:
        yield from _nodes(child)


def _checked(spark: SparkSession, sql: str, tables: dict[str, DataFrame], namespace: str) -> str:
    """The text with each relation under its view name; ValueError for anything not allowed."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as e:
        raise ValueError(f"not a statement Spark can parse: {sql.strip()[:80]!r}") from e
    if ".plans.logical." not in plan.getClass().getName() or _commands(plan):
        raise ValueError(f"only queries are permitted: {sql.strip()[:80]!r}")
    nodes = list(_nodes(plan))
    own = {pair._1().lower() for node in nodes if _kind(node) == "UnresolvedWith" for pair in _items(node.cteRelations())}
    views = {name.lower(): name for name in tables}
    spans = set()
    for node in nodes:
        if _kind(node) == "UnresolvedRelation":
            parts = list(_items(node.multipartIdentifier()))
            name = parts[-1].lower()
            if len(parts) == 1 and name in own:
                continue
            if name not in views or len(parts) > 2 or (len(parts) == 2 and parts[0].lower() != namespace.lower()):
                raise ValueError(f"unknown table {'.'.join(parts)!r}; known: {', '.join(sorted(tables))}")
            origin = node.origin()
            spans.add((origin.startIndex().get(), origin.stopIndex().get(), views[name]))
        elif _kind(node) == "UnresolvedFunction":
            name = list(_items(node.nameParts()))[-1].lower()
            if name in FORBIDDEN_FUNCTIONS:
                raise ValueError(f"function {name!r} is not permitted")
    # Positions come from the parser, so literals and comments are never touched.
    for start, stop, name in sorted(spans, reverse=True):
        if not sql[start : stop + 1].replace("`", "").lower().endswith(name.lower()):
            raise ValueError(f"cannot place table {name!r} in the statement")
        sql = sql[:start] + f"`{name}`" + sql[stop + 1 :]
    return sql


def _commands(plan) -> bool:
    return any(
        c.getName().rsplit(".", 1)[-1] in ("Command", "ParsedStatement", "UnaryCommand", "LeafCommand", "V2WriteCommand")
        for c in _supertypes(plan.getClass())
    )


def _supertypes(cls) -> Iterator:
    while cls is not None:
        yield cls
        for i in cls.getInterfaces():
            yield from _supertypes(i)
        cls = cls.getSuperclass()


def guarded_query(
    spark: SparkSession, sql: str, tables: dict[str, DataFrame], limit: int | None = None, namespace: str = NAMESPACE
) -> DataFrame:
    """One query over the given tables, all its rows; at most ``limit`` of them if that is given.

    Tables may be named with a ``namespace.`` before them. A statement that is not a query, or that
    reads or calls anything else, raises ValueError before it is analysed.
    """
    text = _checked(spark, sql, tables, namespace)
    session = spark.newSession()
    for name, df in tables.items():
        _view(session, name, df)
    out = session.sql(text)
    return out if limit is None else out.limit(limit)


def _view(session: SparkSession, name: str, df: DataFrame) -> None:
    """``df`` as a view of ``session`` only."""
    plan = df._jdf.queryExecution().analyzed()
    frame = session._jvm.org.apache.spark.sql.classic.Dataset.ofRows(session._jsparkSession, plan)
    frame.createOrReplaceTempView(name)


def preview_table(spark: SparkSession, name: str, tables: dict[str, DataFrame], rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows of a given table; how many is the caller's choice."""
    _, _, simple = name.rpartition(".")
    if simple not in tables:
        raise ValueError(f"unknown table {simple!r}; known: {', '.join(sorted(tables))}")
    return tables[simple].limit(rows)


def list_namespaces(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES").select("namespace")


def list_tables(spark: SparkSession, namespace: str = "default") -> DataFrame:
    return spark.sql("SHOW TABLES IN IDENTIFIER(:ns)", args={"ns": namespace}).select(
        F.col("tableName").alias("tabla"), F.col("isTemporary").alias("temporal")
    )
