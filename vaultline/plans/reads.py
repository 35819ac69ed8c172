"""Read operations: filtered, ordered and paged lists, one customer in detail, dashboard figures."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.plans.analytics import dashboard_kpis, down, up

# Bounds of a page.
DEFAULT_LIMIT, MAX_LIMIT = 50, 200
#: Pages behind so many rows are not reached by sorting all rows before them.
DEEP = 10_000
#: Into so many ranges each pass of the search for a deep page cuts what is left.
CUTS = 64

CUSTOMER_COLUMNS = (
    "customer_id", "name", "gender", "city", "state", "email", "occupation", "annual_income", "credit_score", "join_date",
)


def page(frame: DataFrame, order: dict[str, Callable], limit: int, offset: int = 0, after: tuple | None = None) -> DataFrame:
    """One page in a total order: columns, each ``up`` or ``down``.

    ``after`` holds the values of these columns in the last row of the page before. Earlier rows are then
    filtered out at the scan and each task keeps ``limit`` rows, however deep the page. Without it a page
    from ``DEEP`` on is found by order statistics (see ``_start_of``), so that no task keeps more than ``DEEP + limit`` rows.
    The columns hold no NULL.
    """
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    if after is not None:
        frame = frame.where(_behind(order, after))
    if offset > DEEP:
        start, skipped = _start_of(frame, order, offset)
        if start:
            frame, offset = frame.where(_behind(order, start, True)), offset - skipped
    return frame.orderBy(*[direction(name) for name, direction in order.items()]).offset(offset).limit(limit)


def _behind(order: dict[str, Callable], after: tuple, or_at: bool = False) -> Column:
    """Rows behind the given values in the page's order; with ``or_at`` of as many columns as there are values, and not before them."""
    if len(after) != len(order) and not or_at:
        raise ValueError(f"after needs values of {', '.join(order)}")
    behind = F.lit(True) if or_at else None
    for (name, direction), value in reversed(list(zip(order.items(), after))):
        further = F.col(name) > value if direction is up else F.col(name) < value
        behind = further if behind is None else further | ((F.col(name) == value) & behind)
    return behind


def _start_of(frame: DataFrame, order: dict[str, Callable], offset: int) -> tuple[tuple, int]:
    """Values of the leading columns, and how many rows are before them: as many as ``offset`` or up to ``DEEP`` fewer.

    Each pass cuts the rows that come into question at quantiles of one column, counts how many are before each cut and goes on
    between two of them, so the rows left shrink by a factor of ``CUTS``; only that column is read. Where a single value
    has them all, the next column goes on among its rows. A few values a pass come to the driver.
    """
    start: list = []
    skipped = 0
    for name, direction in order.items():
        forward, column = direction is up, F.col(name)
        before = lambda value: column < F.lit(value) if forward else column > F.lit(value)  # noqa: E731, B023
        low = high = None
        while True:
            inside = frame.select(name)
            if low is not None:
                inside = inside.where(~before(low))
            if high is not None:
                inside = inside.where(before(high))
            shares = [at / CUTS for at in range(1, CUTS)]
            found = inside.agg(F.percentile_approx(name, shares, 100 * CUTS)).first()[0] or []
            cuts = [cut for cut in sorted(set(found), reverse=not forward) if cut != low]
            if not cuts:  # nearly all rows left have one value
                if low is None:
                    return tuple(start), skipped
                same, further = inside.agg(
                    F.count_if(column == F.lit(low)), (F.min if forward else F.max)(F.when(column != F.lit(low), column))
                ).first()
                if offset - skipped < same or further is None:
                    break
                low, skipped = further, skipped + same
            else:
                counts = [0, *inside.agg(*[F.count_if(before(cut)) for cut in cuts]).first()]
                at = max(i for i, n in enumerate(counts) if n <= offset - skipped)
                if at:
                    low, skipped = cuts[at - 1], skipped + counts[at]
                elif low is None:  # the first cut is too far: begin with the very first value
                    low = inside.agg((F.min if forward else F.max)(name)).first()[0]
                high = cuts[at] if at < len(cuts) else high
            if offset - skipped <= DEEP:
                return (*start, low), skipped
        start.append(low)
        frame = frame.where(column == F.lit(low))
    return tuple(start), skipped


def _positive(**ids: int | None) -> None:
    for name, value in ids.items():
        if value is not None and value <= 0:
            raise ValueError(f"{name} must be a positive integer")


def same_text(column: str, value: str) -> Column:
    return F.lower(column) == F.lower(F.lit(value))


def contains_text(column: str, value: str) -> Column:
    """Case-insensitive containment; ``%`` and ``_`` in the value stand for themselves."""
    escaped = value.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return F.col(column).ilike(f"%{escaped}%")


def list_customers(bank, limit: int = DEFAULT_LIMIT, offset: int = 0, city: str | None = None, after: tuple | None = None) -> DataFrame:
    rows = bank["customers"].select(*CUSTOMER_COLUMNS)
    if city:
        rows = rows.where(same_text("city", city))
    return page(rows, {"customer_id": up}, limit, offset, after)


def list_accounts(
    bank, customer_id: int | None = None, account_type: str | None = None, limit: int = DEFAULT_LIMIT, offset: int = 0,
    after: tuple | None = None,
) -> DataFrame:
    _positive(customer_id=customer_id)
    rows = bank["accounts"]
    if customer_id:
        rows = rows.where(F.col("customer_id") == customer_id)
    if account_type:
        rows = rows.where(same_text("account_type", account_type))
    return page(rows, {"account_id": up}, limit, offset, after)


def list_transactions(bank, account_id: int | None = None, limit: int = DEFAULT_LIMIT, offset: int = 0,
                      after: tuple | None = None) -> DataFrame:
    _positive(account_id=account_id)
    rows = bank["transactions"]
    if account_id:
        rows = rows.where(F.col("account_id") == account_id)
    return page(rows, {"txn_date": down, "transaction_id": down}, limit, offset, after)


def list_loans(
    bank, customer_id: int | None = None, status: str | None = None, limit: int = DEFAULT_LIMIT, offset: int = 0,
    after: tuple | None = None,
) -> DataFrame:
    _positive(customer_id=customer_id)
    rows = bank["loans"]
    if customer_id:
        rows = rows.where(F.col("customer_id") == customer_id)
    if status:
        rows = rows.where(same_text("status", status))
    return page(rows, {"loan_id": up}, limit, offset, after)


def list_cards(
    bank, customer_id: int | None = None, card_type: str | None = None, limit: int = DEFAULT_LIMIT, offset: int = 0,
    after: tuple | None = None,
) -> DataFrame:
    _positive(customer_id=customer_id)
    rows = bank["cards"]
    if customer_id:
        rows = rows.where(F.col("customer_id") == customer_id)
    if card_type:
        rows = rows.where(same_text("card_type", card_type))
    return page(rows, {"card_id": up}, limit, offset, after)


def list_customer_360(bank, segment: str | None = None, limit: int = DEFAULT_LIMIT, offset: int = 0,
                      after: tuple | None = None) -> DataFrame:
    rows = bank["customer_360"]
    if segment:
        rows = rows.where(contains_text("customer_segment", segment))
    return page(rows, {"total_deposit_balance": down, "customer_id": up}, limit, offset, after)


DETAIL_SECTIONS = ("customers", "customer_360", "accounts", "loans", "cards")


def customer_detail(bank, customer_id: int) -> dict[str, DataFrame]:
    """Everything about one customer, one frame per section; all are empty if the id is unknown.

    The lists stay distributed frames: a customer may own any number of accounts. The filter
    reaches every scan.
    """
    _positive(customer_id=customer_id)
    return {name: bank[name].where(F.col("customer_id") == customer_id) for name in DETAIL_SECTIONS}


def customer_detail_rows(bank, customer_id: int) -> DataFrame:
    """The same as one frame: ``section`` and every column of every section, NULL where a section has none."""
    parts = [frame.select(F.lit(name).alias("section"), "*") for name, frame in customer_detail(bank, customer_id).items()]
    return reduce(lambda above, below: above.unionByName(below, allowMissingColumns=True), parts)


def segment_counts(bank) -> DataFrame:
    return bank["customer_360"].groupBy("customer_segment").agg(F.count("*").alias("count"))


__all__ = [
    "customer_detail", "customer_detail_rows", "dashboard_kpis", "list_accounts", "list_cards", "list_customer_360", "list_customers",
    "list_loans", "list_transactions", "page", "segment_counts",
]
