"""Question routing and context building for a table of questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope import fixed
from lendscope.functions.text import fill, route_words
from lendscope.operators.search import bm25, hit_rows
from lendscope.operators.word_index import WordIndex, where_any
from lendscope.plans.scoring import latest_macro
from lendscope.session import materialize
from lendscope.sources.tables import Book


def route_first(question: Column) -> Column:
    """The first dataset one of whose words occurs in the question; NULL when none does."""
    result = F
    for dataset, words in fixed.ROUTES_FIRST:
        result = result.when(route_words(question, words), F.lit(dataset))
    return result.otherwise(F.lit(None).cast("string"))


def route_all(question: Column) -> Column:
    """Every dataset with a matching word, in fixed order; the score table when none matches."""
    hits = F.array_compact(
        F.array(*[F.when(route_words(question, words), F.lit(dataset)) for dataset, words in fixed.ROUTES_ALL])
    )
    return F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit(fixed.ROUTE_DEFAULT)))


def csv_line(*columns: Column) -> Column:
    """One CSV line: NULL is empty, and a value with a comma, a quote or a line break is quoted."""

    def shown(column: Column) -> Column:
        text = column.cast("string")
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.coalesce(F.when(text.rlike('[,"\n\r]'), quoted).otherwise(text), F.lit(""))

    parts = [shown(columns[0])]
    for column in columns[1:]:
        parts += [F.lit(","), shown(column)]
    return F.concat(*parts)


def _dataset_text(
    df: DataFrame, heading: str, columns: list[str], order: list[str], rows: int | None = None
) -> DataFrame:
    """One row: heading, CSV head and the first lines (at most ``rows``), cut to the data context."""
    enough = _enough(columns, rows)
    line = csv_line(*[F.col(column) for column in columns])
    first = df.orderBy(*order).limit(enough).select(F.struct(*order).alias("key"), line.alias("line"))
    items = F.array_sort(F.collect_list(F.struct("key", "line")))
    body = F.array_join(F.transform(items, lambda item: item["line"]), "\n")
    head = f"{heading}\n{','.join(columns)}\n"
    text = F.left(F.concat(F.lit(head), body, F.lit("\n")), F.lit(fixed.DATA_CONTEXT_LENGTH))
    return first.agg(text.alias("text"))


# --- fixed values: the columns each dataset shows in the long and in the first, shorter form ---
COLUMNS = {
    "risk_scores": ["company_name", "sector", "composite_score", "risk_grade", "key_risk_drivers"],
    "loan_exposure": ["company_name", "sector", "loan_type", "outstanding_balance", "collateral_value", "loan_status"],
    "applications": [
        "company_name", "loan_type", "requested_amount", "application_status", "ai_recommendation", "ai_recommendation_reason",
    ],
    "macro": ["indicator_name", "value", "change_pct", "report_date"],
}
COLUMNS_FIRST = {
    "risk_scores": ["company_name", "composite_score", "risk_grade", "key_risk_drivers"],
    "loan_exposure": ["company_name", "loan_type", "outstanding_balance", "collateral_value", "loan_status"],
    "applications": ["company_name", "loan_type", "requested_amount", "application_status", "ai_recommendation"],
    "macro": ["indicator_name", "value", "change_pct", "report_date", "source"],
}
ORDERS = {
    "risk_scores": ["composite_score", "customer_id"],
    "loan_exposure": ["_falling", "loan_id"],
    "applications": ["_falling", "application_id"],
    "macro": ["indicator_name"],
}


def _enough(columns: list[str], rows: int | None) -> int:
    """Rows that can reach the data context: a line has at least the commas between its columns and its break."""
    return min(rows or fixed.DATA_CONTEXT_LENGTH, fixed.DATA_CONTEXT_LENGTH // len(columns) + 1)


def first_named(rows: DataFrame, names: DataFrame, order: list[str], most: int) -> DataFrame:
    """Rows with the name of their customer, among them the ``most`` first in the order, whose last column is the rows' key.

    Twice as many keys are taken first, and only their customers looked up; as long as enough of them have one, nothing but
    the rows of these keys meets the customers, or whatever the rows are derived from. Otherwise all rows do.
    """
    key = order[-1]
    keys = materialize(rows.sparkSession, rows.select("customer_id", *order).orderBy(*order).limit(2 * most), "first-keys")
    named = keys.join(names.select("customer_id"), "customer_id").groupBy(key).agg(F.count(F.lit(1)).alias("n")).collect()
    if sum(row["n"] for row in named) < most and keys.count() == 2 * most:
        return rows.join(names, "customer_id")
    wanted = where_any({key: [row[key] for row in named]})
    return rows.where(wanted).join(names, "customer_id")


def dataset_texts(book: Book, first: bool = False) -> dict[str, DataFrame]:
    """The text of each dataset a question can be routed to, as one-row DataFrames.

    The first form shows fewer columns, only active loans, and the first rows of each dataset but macro.
    """
    names = book["customers"].select("customer_id", "company_name", "sector")
    loans = book["loan_history"].filter(F.col("loan_status") == "ACTIVE") if first else book["loan_history"]
    headings = fixed.ROUTE_HEADINGS_FIRST if first else fixed.ROUTE_HEADINGS
    columns = COLUMNS_FIRST if first else COLUMNS
    rows = {name: fixed.WORST_ROWS if first and name != "macro" else None for name in columns}

    def of_customers(name: str, df: DataFrame) -> DataFrame:
        return first_named(df, names, ORDERS[name], _enough(columns[name], rows[name]))

    days = -F.datediff("application_date", F.lit("1970-01-01"))
    frames = {
        "risk_scores": book["risk_scores"],
        "loan_exposure": of_customers("loan_exposure", loans.withColumn("_falling", -F.col("outstanding_balance"))),
        "applications": of_customers("applications", book["loan_applications"].withColumn("_falling", days)),
        "macro": latest_macro(book),
    }
    return {
        name: _dataset_text(frame, headings[name], columns[name], ORDERS[name], rows[name]) for name, frame in frames.items()
    }


def data_context(book: Book, questions: DataFrame, question: str = "question") -> DataFrame:
    """Adds ``datasets`` and ``data_context``: the texts of all matching datasets, cut to the limit."""
    words = dict(fixed.ROUTES_ALL)[fixed.ROUTE_DEFAULT]
    routed = questions.withColumn("datasets", route_all(F.col(question))).withColumn(
        "_routed", F.coalesce(route_words(F.col(question), words), F.lit(False))
    )
    pieces = []
    for dataset, text in dataset_texts(book).items():
        routed = routed.withColumn(f"_{dataset}", text.scalar())
        # The default text stands alone, without the break that follows a matching one.
        end = F.when(F.col("_routed"), "\n").otherwise("") if dataset == fixed.ROUTE_DEFAULT else F.lit("\n")
        pieces.append(F.when(F.array_contains("datasets", dataset), F.concat(F.col(f"_{dataset}"), end)))
    whole = F.left(F.array_join(F.array_compact(F.array(*pieces)), ""), F.lit(fixed.DATA_CONTEXT_LENGTH))
    return routed.withColumn("data_context", whole).drop(*[column for column in routed.columns if column[0] == "_"])


def policy_context(
    questions: DataFrame,
    corpus: DataFrame,
    key: str,
    title: str,
    text: str,
    hits: int = fixed.HITS_ADVISOR,
    length: int = fixed.HIT_LENGTH,
    form: str = "[{title} - {section}]: {text}\n\n",
    separator: str = "",
    section: str = "section",
    index: WordIndex | None = None,
) -> DataFrame:
    """query_id and ``context``: the best hits by rank in the given form, each hit and the whole cut to its limit.

    With the corpus' stored index, only the hits are read from the corpus.
    """
    found = bm25(corpus, questions, hits, key, text) if index is None else index.best(questions, hits)
    named = {"section": f"coalesce({section}, '')"} if "{section}" in form else {}
    line = fill(form, title=title, text=f"left({text}, {length})", **named)
    lines = hit_rows(found, questions, hits, corpus, key, [line.alias("line")])
    items = F.transform(F.array_sort(F.collect_list(F.struct("rank", "line"))), lambda item: item["line"])
    context = F.left(F.array_join(items, separator), F.lit(fixed.POLICY_CONTEXT_LENGTH))
    return lines.groupBy("query_id").agg(context.alias("context"))


def _with_context(questions: DataFrame, contexts: DataFrame) -> DataFrame:
    joined = questions.join(contexts, "query_id", "left")
    return joined.withColumn("context", F.coalesce("context", F.lit("")))


def question_context(
    book: Book,
    questions: DataFrame,
    corpus: DataFrame,
    key: str,
    title: str,
    text: str,
    section: str = "section",
    index: WordIndex | None = None,
) -> DataFrame:
    """query_id, query, datasets, data_context and policy context ('' without a hit) of every question."""
    with_data = data_context(book, questions, "query")
    return _with_context(with_data, policy_context(questions, corpus, key, title, text, section=section, index=index))


def question_context_first(
    book: Book, questions: DataFrame, corpus: DataFrame, key: str, title: str, text: str, index: WordIndex | None = None
) -> DataFrame:
    """The shorter form: the first matching dataset with its first rows (none without a match) and two hits."""
    routed = questions.withColumn("dataset", route_first(F.col("query")))
    data = F.lit("")
    for dataset, one_row in dataset_texts(book, first=True).items():
        routed = routed.withColumn(f"_{dataset}", one_row.scalar())
        data = F.when(F.col("dataset") == dataset, F.col(f"_{dataset}")).otherwise(data)
    with_data = routed.withColumn("data_context", data).select(*questions.columns, "dataset", "data_context")
    contexts = policy_context(
        questions, corpus, key, title, text, fixed.HITS_ADVISOR_FIRST, fixed.HIT_LENGTH_FIRST, "{title}: {text}", "\n", index=index
    )
    return _with_context(with_data, contexts)
