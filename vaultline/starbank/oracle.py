"""The queries in plain SQL over the base tables, as an independent statement of their results.

Each statement derives raw, judged and curated tables as common table expressions and then
computes the query in the most direct way: windows for duplicates, subqueries for foreign keys,
joins before aggregation, integer arithmetic for rounding. It shares only the raw projections
and query parameters with the Spark side.
"""

from __future__ import annotations

import re

from vaultline.starbank import registry
from vaultline.starbank.raw import BASE_TABLES, RAW_SQL

NAMES = tuple(RAW_SQL)


def strip(x: str) -> str:
    return f"trim({x}, ' ' || chr(9) || chr(10) || chr(13))"


def num(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({strip(x)}, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') "
        f"THEN try_cast({strip(x)} AS DOUBLE) END"
    )


def pk(x: str) -> str:
    return f"CAST(trunc({num(x)}) AS BIGINT)"


def ref(x: str) -> str:
    return f"CASE WHEN {num(x)} = trunc({num(x)}) THEN CAST({num(x)} AS BIGINT) END"


def time(x: str) -> str:
    zone = "(Z|[+-]\\d{2}:?\\d{2})"
    pattern = f"\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}([ T]\\d{{1,2}}:\\d{{1,2}}(:\\d{{1,2}}(\\.\\d+)?)?{zone}?)?"
    written = f"regexp_replace({strip(x)}, '(:[0-9.]+){zone}$', '\\1')"
    return f"CASE WHEN regexp_full_match({strip(x)}, '{pattern}') THEN try_cast({written} AS TIMESTAMP) END"


def day(x: str) -> str:
    return f"CAST({time(x)} AS DATE)"


def numtext(x: str) -> str:
    n = num(x)
    return (
        f"CASE WHEN {n} IS NULL THEN 'nan' WHEN {n} = trunc({n}) THEN CAST(CAST({n} AS BIGINT) AS VARCHAR) "
        f"ELSE rtrim(CAST(CAST({n} AS DECIMAL(30,6)) AS VARCHAR), '0') END"
    )


def title(x: str) -> str:
    words = f"regexp_extract_all(lower({strip(x)}), '[a-z]+|[^a-z]+')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), '')"


def capital(x: str) -> str:
    return f"upper({strip(x)}[1]) || lower({strip(x)}[2:])"


def money(x: str, precision: int = 15) -> str:
    return f"CAST({num(x)} AS DECIMAL({precision},2))"


def shown(x: str) -> str:
    return f"coalesce({strip(x)}, 'nan')"


def blank(x: str) -> str:
    return f"({x} IS NULL OR {strip(x)} = '')"


def outside(x: str, values: tuple[str, ...]) -> str:
    inside = ", ".join(f"'{v.upper()}'" for v in values)
    return f"({x} IS NULL OR upper({strip(x)}) NOT IN ({inside}))"


def orphan(x: str, parent: str, parent_key: str) -> str:
    return f"(({ref(x)}) IS NULL OR ({ref(x)}) NOT IN (SELECT {parent_key} FROM {parent}))"


SI, PK, RI = "Schema Integrity", "Primary Key Constraint", "Referential Integrity"
DB, FV, CL, AR = "Domain Boundary Check", "Format Validation", "Chronological Logic", "Accounting Reconciliation"

KEYS = {
    "branches": ("branch_id", "Branch"),
    "employees": ("employee_id", "Employee"),
    "customers": ("customer_id", "Customer"),
    "accounts": ("account_id", "Account"),
    "transactions": ("transaction_id", "Transaction"),
    "loans": ("loan_id", "Loan"),
    "loan_payments": ("payment_id", "Payment"),
    "cards": ("card_id", "Card"),
    "card_transactions": ("card_txn_id", "Card Txn"),
    "support_tickets": ("ticket_id", "Ticket"),
}


#: The tables whose curated keys each table needs.
PARENTS = {
    "employees": ("branches",),
    "accounts": ("customers",),
    "transactions": ("accounts",),
    "loans": ("customers",),
    "loan_payments": ("loans",),
    "cards": ("customers", "accounts"),
    "card_transactions": ("cards",),
    "support_tickets": ("customers",),
}


def _identity(name: str):
    key, entity = KEYS[name]
    return [
        ("missing_key", SI, blank(key), f"'Missing {entity} ID'"),
        ("non_numeric_key", SI, f"(NOT {blank(key)} AND ({pk(key)}) IS NULL)", f"'Non-numeric {entity} ID'"),
        ("duplicate_key", PK, "copies > 1", f"'Duplicate {entity} ID'"),
    ]


def _orphan_rule(column: str, entity: str, parent: str):
    key = KEYS[parent][0]
    return (
        f"orphan_key:{column}", RI, orphan(column, parent, key),
        f"'{entity} ID ' || {numtext(column)} || ' not found in Curated {parent.title()}'",
    )


def _not_above_zero(x: str) -> str:
    return f"(({num(x)}) IS NULL OR ({num(x)}) <= 0)"


def _note(text: str, value: str) -> str:
    return f"'{text} (' || {value} || ')'"


def _raw(x: str) -> str:
    return f"coalesce({x}, 'nan')"


RULES = {
    "branches": [
        *_identity("branches"),
        ("blank:branch_name", DB, blank("branch_name"), "'Missing Branch Name'"),
        ("blank:city,state", DB, f"({blank('city')} OR {blank('state')})", "'Missing City or State'"),
        ("bad_date:opened_date", FV, f"({time('opened_date')}) IS NULL", "'Invalid Opened Date'"),
        ("blank:ifsc_code", DB, blank("ifsc_code"), "'Missing IFSC Code'"),
    ],
    "employees": [
        *_identity("employees"),
        _orphan_rule("branch_id", "Branch", "branches"),
        ("not_in_domain:role", DB,
         outside("role", ("Teller", "Customer Service", "Relationship Manager", "Loan Officer", "Branch Manager",
                          "Compliance Officer")),
         _note("Invalid Employee Role", shown("role"))),
        ("out_of_range:salary", DB, _not_above_zero("salary"), _note("Invalid Salary", numtext("salary"))),
        ("bad_date:hire_date", FV, f"({time('hire_date')}) IS NULL", "'Invalid Hire Date'"),
    ],
    "customers": [
        *_identity("customers"),
        ("pattern_mismatch:email", FV,
         f"(email IS NULL OR NOT regexp_full_match({strip('email')}, '[a-zA-Z0-9_.+\\-]+@[a-zA-Z0-9\\-]+\\.[a-zA-Z0-9\\-.]+'))",
         "'Invalid Email'"),
        ("out_of_range:credit_score", DB,
         f"(({num('credit_score')}) IS NULL OR ({num('credit_score')}) NOT BETWEEN 300 AND 850)",
         _note("Invalid Credit Score", numtext("credit_score"))),
        ("out_of_range:annual_income", DB, _not_above_zero("annual_income"), "'Non-positive Annual Income'"),
    ],
    "accounts": [
        *_identity("accounts"),
        _orphan_rule("customer_id", "Customer", "customers"),
        ("out_of_range:balance", DB, f"(({num('balance')}) IS NULL OR ({num('balance')}) < 0)",
         _note("Invalid Balance", numtext("balance"))),
        ("not_in_domain:account_type", DB, outside("account_type", ("Savings", "Current", "Salary", "Fixed Deposit", "NRI")),
         _note("Invalid Account Type", shown("account_type"))),
        ("not_in_domain:status", DB, outside("status", ("Active", "Dormant", "Closed")),
         _note("Invalid Status", f"coalesce({capital('status')}, 'Nan')")),
    ],
    "transactions": [
        *_identity("transactions"),
        _orphan_rule("account_id", "Account", "accounts"),
        ("out_of_range:amount", DB, _not_above_zero("amount"), _note("Invalid Transaction Amount", numtext("amount"))),
        ("not_in_domain:txn_type", DB,
         outside("txn_type", ("Deposit", "Withdrawal", "Transfer Out", "Transfer In", "Fee Debit", "Interest Credit")),
         _note("Invalid Transaction Type", shown("txn_type"))),
        ("not_in_domain:channel", DB, outside("channel", ("Mobile App", "Branch", "ATM", "UPI", "POS", "Online Banking")),
         _note("Invalid Channel", shown("channel"))),
        ("bad_date:txn_date", FV, f"({time('txn_date')}) IS NULL", _note("Invalid Date format", _raw("txn_date"))),
    ],
    "loans": [
        *_identity("loans"),
        _orphan_rule("customer_id", "Customer", "customers"),
        ("out_of_range:loan_amount", DB, _not_above_zero("loan_amount"), _note("Invalid Loan Amount", numtext("loan_amount"))),
        ("out_of_range:interest_rate", DB, f"({_not_above_zero('interest_rate')} OR ({num('interest_rate')}) > 50)",
         _note("Invalid Interest Rate", numtext("interest_rate"))),
        ("out_of_range:term_months", DB, _not_above_zero("term_months"), _note("Invalid Term Months", numtext("term_months"))),
        ("not_in_domain:loan_type", DB,
         outside("loan_type", ("Auto Loan", "Business Loan", "Education Loan", "Gold Loan", "Home Loan", "Personal Loan")),
         _note("Invalid Loan Type", shown("loan_type"))),
        ("not_in_domain:status", DB, outside("status", ("Active", "Closed", "Defaulted", "Written Off")),
         _note("Invalid Loan Status", shown("status"))),
        ("bad_date:start_date", FV, f"({time('start_date')}) IS NULL", _note("Invalid Start Date", _raw("start_date"))),
    ],
    "loan_payments": [
        *_identity("loan_payments"),
        _orphan_rule("loan_id", "Loan", "loans"),
        ("out_of_range:amount_paid", DB, _not_above_zero("amount_paid"), _note("Invalid Amount Paid", numtext("amount_paid"))),
        ("components_unbalanced:amount_paid", AR,
         f"(({num('principal_component')}) IS NULL OR ({num('interest_component')}) IS NULL "
         f"OR ({num('principal_component')}) < 0 OR ({num('interest_component')}) < 0 OR coalesce(abs("
         f"({num('principal_component')}) + ({num('interest_component')}) - ({num('amount_paid')})) > 0.05, false))",
         "'Principal and Interest components do not balance to Amount Paid'"),
        ("not_binary:late_payment_flag", DB,
         f"(({num('late_payment_flag')}) IS NULL OR ({num('late_payment_flag')}) NOT IN (0, 1))",
         _note("Invalid Late Payment Flag", _raw("late_payment_flag"))),
        ("bad_date:payment_date", FV, f"({time('payment_date')}) IS NULL", _note("Invalid Payment Date", _raw("payment_date"))),
    ],
    "cards": [
        *_identity("cards"),
        _orphan_rule("customer_id", "Customer", "customers"),
        _orphan_rule("account_id", "Account", "accounts"),
        ("not_in_domain:card_type", DB, outside("card_type", ("Debit", "Credit - Classic", "Credit - Gold", "Credit - Platinum")),
         _note("Invalid Card Type", shown("card_type"))),
        ("not_in_domain:status", DB, outside("status", ("Active", "Blocked", "Expired")),
         _note("Invalid Card Status", shown("status"))),
        ("bad_date:issue_date,expiry_date", FV,
         f"(({time('issue_date')}) IS NULL OR ({time('expiry_date')}) IS NULL)",
         "'Invalid date format in issue_date or expiry_date'"),
        ("date_before:expiry_date,issue_date", CL, f"coalesce(({time('expiry_date')}) < ({time('issue_date')}), false)",
         f"'Expiry date (' || strftime({time('expiry_date')}, '%Y-%m-%d %H:%M:%S') || ') before issue date (' || "
         f"strftime({time('issue_date')}, '%Y-%m-%d %H:%M:%S') || ')'"),
        ("out_of_range:credit_limit", DB, f"(({num('credit_limit')}) IS NULL OR ({num('credit_limit')}) < 0)",
         _note("Invalid Credit Limit", numtext("credit_limit"))),
    ],
    "card_transactions": [
        *_identity("card_transactions"),
        _orphan_rule("card_id", "Card", "cards"),
        ("out_of_range:amount", DB, _not_above_zero("amount"), _note("Invalid Transaction Amount", numtext("amount"))),
        ("blank:merchant_category", DB, blank("merchant_category"), "'Missing Merchant Category'"),
        ("bad_date:txn_date", FV, f"({time('txn_date')}) IS NULL", _note("Invalid Txn Date", _raw("txn_date"))),
        ("not_binary:is_fraud", DB, f"(({num('is_fraud')}) IS NULL OR ({num('is_fraud')}) NOT IN (0, 1))",
         _note("Invalid Fraud Flag", _raw("is_fraud"))),
    ],
    "support_tickets": [
        *_identity("support_tickets"),
        _orphan_rule("customer_id", "Customer", "customers"),
        ("blank:issue_type", DB, blank("issue_type"), "'Missing Issue Type'"),
        ("not_in_domain:status", DB, outside("status", ("Resolved", "Open", "Escalated")),
         _note("Invalid Status", shown("status"))),
        ("bad_date:date_opened", FV, f"({time('date_opened')}) IS NULL", "'Invalid Date Opened'"),
        ("date_before:date_resolved,date_opened", CL, f"coalesce(({time('date_resolved')}) < ({time('date_opened')}), false)",
         f"'Date resolved (' || strftime({time('date_resolved')}, '%Y-%m-%d %H:%M:%S') || ') before opened (' || "
         f"strftime({time('date_opened')}, '%Y-%m-%d %H:%M:%S') || ')'"),
        ("out_of_range:satisfaction_score", DB,
         f"(({num('satisfaction_score')}) IS NULL OR ({num('satisfaction_score')}) NOT BETWEEN 1 AND 5)",
         _note("Invalid Satisfaction Score", numtext("satisfaction_score"))),
    ],
}

RAW_COLUMNS = {
    "branches": ("branch_id", "branch_name", "city", "state", "opened_date", "ifsc_code"),
    "employees": ("employee_id", "name", "branch_id", "role", "hire_date", "salary"),
    "customers": ("customer_id", "name", "gender", "date_of_birth", "city", "state", "phone", "email", "occupation",
                  "annual_income", "join_date", "credit_score"),
    "accounts": ("account_id", "customer_id", "branch_id", "account_type", "balance", "open_date", "status"),
    "transactions": ("transaction_id", "account_id", "txn_date", "txn_type", "amount", "channel", "merchant_category"),
    "loans": ("loan_id", "customer_id", "branch_id", "loan_type", "loan_amount", "interest_rate", "term_months",
              "start_date", "status"),
    "loan_payments": ("payment_id", "loan_id", "payment_date", "amount_paid", "principal_component",
                      "interest_component", "late_payment_flag"),
    "cards": ("card_id", "customer_id", "account_id", "card_type", "issue_date", "expiry_date", "credit_limit", "status"),
    "card_transactions": ("card_txn_id", "card_id", "txn_date", "merchant_category", "amount", "is_fraud"),
    "support_tickets": ("ticket_id", "customer_id", "issue_type", "date_opened", "date_resolved", "status",
                        "satisfaction_score"),
}


def _int(x: str, type: str = "INTEGER") -> str:
    return f"CAST(trunc({num(x)}) AS {type})"


# How each curated column comes from its raw text; keys use the integral part of the number.
STANDARD = {
    "branches": [pk("branch_id"), title("branch_name"), title("city"), title("state"), day("opened_date"),
                 f"upper({strip('ifsc_code')})"],
    "employees": [pk("employee_id"), title("name"), ref("branch_id"), title("role"), day("hire_date"), money("salary", 12)],
    "customers": [pk("customer_id"), title("name"), capital("gender"), day("date_of_birth"), title("city"),
                  title("state"), "phone", f"lower({strip('email')})", title("occupation"), money("annual_income"),
                  day("join_date"), _int("credit_score")],
    "accounts": [pk("account_id"), ref("customer_id"), pk("branch_id"),
                 f"CASE WHEN upper({strip('account_type')}) = 'NRI' THEN 'NRI' ELSE {title('account_type')} END",
                 money("balance"), day("open_date"), capital("status")],
    "transactions": [pk("transaction_id"), ref("account_id"), day("txn_date"), title("txn_type"), money("amount"),
                     title("channel"), title("merchant_category")],
    "loans": [pk("loan_id"), ref("customer_id"), pk("branch_id"), title("loan_type"), money("loan_amount"),
              money("interest_rate", 5), _int("term_months"), day("start_date"), title("status")],
    "loan_payments": [pk("payment_id"), ref("loan_id"), day("payment_date"), money("amount_paid"),
                      money("principal_component"), money("interest_component"), _int("late_payment_flag", "SMALLINT")],
    "cards": [pk("card_id"), ref("customer_id"), ref("account_id"), title("card_type"), day("issue_date"),
              day("expiry_date"), money("credit_limit"), capital("status")],
    "card_transactions": [pk("card_txn_id"), ref("card_id"), day("txn_date"), title("merchant_category"),
                          money("amount"), _int("is_fraud", "SMALLINT")],
    "support_tickets": [pk("ticket_id"), ref("customer_id"), title("issue_type"), day("date_opened"),
                        day("date_resolved"), capital("status"), _int("satisfaction_score")],
}

MONEY_COLUMNS = {
    "salary", "annual_income", "balance", "amount", "loan_amount", "interest_rate", "amount_paid", "principal_component",
    "interest_component", "credit_limit",
}


def _stages(rules) -> str:
    pieces = []
    for i, (_, stage, _, _) in enumerate(rules):
        earlier = "".join(f" AND NOT b{j}" for j, r in enumerate(rules[:i]) if r[1] == stage)
        pieces.append(f"CASE WHEN b{i}{earlier} THEN '{stage}' END")
    return f"concat_ws('; ', {', '.join(pieces)})"


def _damaged_lines() -> str:
    """Customers as faulty text lines: which are damaged, and the cells of the others."""
    columns = RAW_COLUMNS["customers"]
    fault = "CAST(phone AS BIGINT) % 37"
    cells = [f"coalesce({c}, '')" for c in columns]
    name = f"CASE {fault} WHEN 3 THEN '\"' || name WHEN 4 THEN chr(65533) || name ELSE name END"
    line = "concat_ws(',', " + ", ".join(name if c == "name" else cell for c, cell in zip(columns, cells)) + ")"
    shown = []
    for at, c in enumerate(columns):
        cell = f"CASE WHEN {fault} = 5 THEN 'a, \"b\" ' || name ELSE name END" if c == "name" else c
        late = at >= 8
        shown.append(f"CASE WHEN {fault} IN (1, 3, 4){f' OR {fault} = 2' if late else ''} THEN NULL ELSE {_csv_text(cell)} END AS {c}")
    return f"""SELECT CASE {fault} WHEN 1 THEN 'Too many fields' WHEN 3 THEN 'Unbalanced quotes' WHEN 4 THEN 'Not UTF-8' END AS damage,
        CAST(CASE {fault} WHEN 1 THEN {len(columns) + 2} WHEN 3 THEN {len(columns)} END AS INTEGER) AS fields,
        CASE WHEN {fault} IN (3, 4) THEN {line} WHEN {fault} = 1 THEN {line} || ',extra,more' END AS line,
        {", ".join(shown)} FROM raw_customers"""


def _curate_damaged() -> str:
    """Customers from the faulty lines, by what becomes of each line."""
    columns, key = RAW_COLUMNS["customers"], KEYS["customers"][0]
    fault = "CAST(phone AS BIGINT) % 37"
    cells = [f"CASE WHEN {fault} = 2 THEN NULL ELSE {c} END AS {c}" if at >= 8 else c for at, c in enumerate(columns)]
    same = f"coalesce(CAST({pk(key)} AS VARCHAR), 'text ' || nullif({strip(key)}, ''), 'missing')"
    broken = " OR ".join(f"({r[2]})" for r in RULES["customers"])
    return f"""SELECT * FROM (WITH delivered AS (SELECT {", ".join(cells)} FROM raw_customers WHERE {fault} NOT IN (1, 3, 4)),
        judged AS (SELECT {broken} AS bad FROM (SELECT *, count(*) OVER (PARTITION BY {same}) AS copies FROM delivered))
        SELECT 'curated' AS outcome, count(*) FILTER (NOT bad) AS n FROM judged
        UNION ALL SELECT 'quarantine', count(*) FILTER (bad) FROM judged
        UNION ALL SELECT CASE {fault} WHEN 1 THEN 'Too many fields' WHEN 3 THEN 'Unbalanced quotes' ELSE 'Not UTF-8' END, count(*)
        FROM raw_customers WHERE {fault} IN (1, 3, 4) GROUP BY ALL)"""


def _statements() -> dict[str, str]:
    """Common table expressions by name, in an order in which each uses earlier ones only."""
    found = {}
    for name in NAMES:
        rules, key = RULES[name], KEYS[name][0]
        columns = RAW_COLUMNS[name]
        found[f"raw_{name}"] = RAW_SQL[name].format(**{b: b for b in BASE_TABLES[name]})
        same = f"coalesce(CAST({pk(key)} AS VARCHAR), 'text ' || nullif({strip(key)}, ''), 'missing')"
        broken = ", ".join(f"{r[2]} AS b{i}" for i, r in enumerate(rules))
        found[f"judged_{name}"] = (
            f"SELECT *, {broken} FROM (SELECT *, count(*) OVER (PARTITION BY {same}) AS copies FROM raw_{name})"
        )
        any_broken = " OR ".join(f"b{i}" for i in range(len(rules)))
        standard = ", ".join(f"{e} AS {c}" for e, c in zip(STANDARD[name], columns))
        found[name] = f"SELECT {standard} FROM judged_{name} WHERE NOT ({any_broken})"
        found[f"all_{name}"] = f"SELECT {standard} FROM raw_{name}"
        reasons = ", ".join(f"CASE WHEN b{i} THEN {r[3]} END" for i, r in enumerate(rules))
        found[f"bad_{name}"] = (
            f"SELECT {', '.join(columns)}, concat_ws('; ', {reasons}) AS rejection_reason, "
            f"{_stages(rules)} AS validation_stage, 'process_{name}' AS pipeline_name "
            f"FROM judged_{name} WHERE {any_broken}"
        )
        found[f"broken_{name}"] = " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, '{r[0]}' AS rule, '{r[1]}' AS stage FROM judged_{name} WHERE b{i}"
            for i, r in enumerate(rules)
        )
    found["verdicts"] = " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, (SELECT count(*) FROM raw_{n}) AS total_records, "
        f"(SELECT count(*) FROM {n}) AS curated_records, (SELECT count(*) FROM bad_{n}) AS bad_records"
        for n in NAMES
    )
    found["broken"] = " UNION ALL ".join(f"SELECT * FROM broken_{n}" for n in NAMES)
    found["rejected"] = " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, rejection_reason, validation_stage FROM bad_{n}" for n in NAMES
    )
    found.update(MARTS)
    return found


INCOME = "('Deposit', 'Transfer In', 'Interest Credit')"
EXPENSE = "('Withdrawal', 'Transfer Out', 'Fee Debit')"

MARTS = {
    "bank_side": f"""
        SELECT customer_id, strftime(txn_date, '%Y-%m') AS month_year, count(*) AS n,
               sum(CASE WHEN txn_type IN {INCOME} THEN amount ELSE 0 END) AS credits,
               sum(CASE WHEN txn_type IN {EXPENSE} THEN amount ELSE 0 END) AS debits
        FROM transactions JOIN accounts USING (account_id) GROUP BY ALL""",
    "card_side": """
        SELECT customer_id, strftime(txn_date, '%Y-%m') AS month_year, sum(amount) AS spend, sum(is_fraud) AS frauds
        FROM card_transactions JOIN cards USING (card_id) GROUP BY ALL""",
    "loan_side": "SELECT customer_id, sum(loan_amount) AS owed FROM loans WHERE status = 'Active' GROUP BY ALL",
    "mcs": """
        SELECT c.customer_id, c.name AS customer_name, b.month_year, c.annual_income, c.credit_score,
               coalesce(b.n, 0) AS bank_transactions_count, coalesce(b.credits, 0) AS total_income_credits,
               coalesce(b.debits, 0) AS total_expense_debits, coalesce(b.credits, 0) - coalesce(b.debits, 0) AS net_cashflow,
               coalesce(k.spend, 0) AS total_card_spend, coalesce(k.frauds, 0) AS card_fraud_count,
               coalesce(l.owed, 0) AS outstanding_loan_balance
        FROM customers c LEFT JOIN bank_side b ON b.customer_id = c.customer_id
        LEFT JOIN card_side k ON k.customer_id = c.customer_id AND k.month_year = b.month_year
        LEFT JOIN loan_side l ON l.customer_id = c.customer_id""",
    "mcs_full": """
        SELECT c.customer_id, c.name AS customer_name, m.month_year, c.annual_income, c.credit_score,
               coalesce(b.n, 0) AS bank_transactions_count, coalesce(b.credits, 0) AS total_income_credits,
               coalesce(b.debits, 0) AS total_expense_debits, coalesce(b.credits, 0) - coalesce(b.debits, 0) AS net_cashflow,
               coalesce(k.spend, 0) AS total_card_spend, coalesce(k.frauds, 0) AS card_fraud_count,
               coalesce(l.owed, 0) AS outstanding_loan_balance
        FROM customers c LEFT JOIN (SELECT customer_id, month_year FROM bank_side UNION SELECT customer_id, month_year FROM card_side) m
          ON m.customer_id = c.customer_id
        LEFT JOIN bank_side b ON b.customer_id = m.customer_id AND b.month_year = m.month_year
        LEFT JOIN card_side k ON k.customer_id = m.customer_id AND k.month_year = m.month_year
        LEFT JOIN loan_side l ON l.customer_id = c.customer_id""",
    "mbs": """
        SELECT branch_id, strftime(txn_date, '%Y-%m') AS month_year, count(DISTINCT customer_id) AS active_customers,
               count(DISTINCT account_id) AS total_accounts, count(*) AS total_transactions, sum(amount) AS total_volume,
               sum(CASE WHEN txn_type IN ('Deposit', 'Transfer In') THEN amount ELSE 0 END) AS deposit_volume,
               sum(CASE WHEN txn_type IN ('Withdrawal', 'Transfer Out') THEN amount ELSE 0 END) AS withdrawal_volume
        FROM transactions JOIN accounts USING (account_id) GROUP BY ALL""",
    "c360": """
        SELECT c.customer_id, c.name, c.gender, c.city, c.state, c.email, c.occupation, c.annual_income, c.credit_score,
               c.join_date,
               (SELECT count(*) FROM accounts a WHERE a.customer_id = c.customer_id) AS total_accounts,
               (SELECT coalesce(sum(balance), 0) FROM accounts a WHERE a.customer_id = c.customer_id) AS total_deposit_balance,
               (SELECT count(*) FROM loans l WHERE l.customer_id = c.customer_id) AS total_loans,
               (SELECT coalesce(sum(loan_amount), 0) FROM loans l WHERE l.customer_id = c.customer_id AND l.status = 'Active')
                 AS active_loan_amount,
               (SELECT count(*) FROM cards k WHERE k.customer_id = c.customer_id) AS total_cards,
               (SELECT coalesce(sum(credit_limit), 0) FROM cards k WHERE k.customer_id = c.customer_id) AS total_credit_limit,
               (SELECT count(*) FROM transactions t JOIN accounts a USING (account_id) WHERE a.customer_id = c.customer_id)
                 AS lifetime_transactions,
               (SELECT coalesce(sum(t.amount), 0) FROM transactions t JOIN accounts a USING (account_id)
                WHERE a.customer_id = c.customer_id) AS lifetime_transaction_volume
        FROM customers c""",
    "customer_360": """
        SELECT *, CASE WHEN credit_score >= 750 AND total_deposit_balance > 50000 THEN 'Premium / Low Risk'
                       WHEN credit_score >= 650 THEN 'Standard / Moderate Risk' ELSE 'Subprime / High Risk' END
                  AS customer_segment
        FROM c360""",
}


def _with(body: str) -> str:
    """The body behind the statements it needs, directly or through others."""
    statements = _statements()
    needed, pending = set(), [body]
    while pending:
        words = set(re.findall(r"[a-z_0-9]+", pending.pop()))
        for name in words & statements.keys() - needed:
            needed.add(name)
            pending.append(statements[name])
    used = [f"{name} AS MATERIALIZED ({sql})" for name, sql in statements.items() if name in needed]
    return ("WITH " + ",\n".join(used) + "\n" + body) if used else body


def ratio(part: str, whole: str, scale: int) -> str:
    """``part / whole`` of non-negative integers, rounded half up in integer arithmetic."""
    p = 10**scale
    return f"CAST((2 * CAST({part} AS HUGEINT) * {p} + {whole}) // (2 * ({whole})) AS DOUBLE) / {p}.0"


def cents(x: str) -> str:
    return f"sum(CAST({x} * 100 AS BIGINT))"


def avg_money(x: str) -> str:
    return ratio(cents(x), f"(count({x}) * 100)", 2)


def pct(part: str, whole: str, scale: int = 2) -> str:
    return ratio(f"({part}) * 100", whole, scale)


def half_even_pct(part: str, whole: str) -> str:
    """``part * 100 / whole`` to 2 places, rounded half even in integer arithmetic."""
    scaled = f"CAST({part} AS HUGEINT) * 10000"
    quotient, rest = f"(({scaled}) // {whole})", f"(({scaled}) % {whole})"
    up = f"CASE WHEN 2 * {rest} > {whole} OR (2 * {rest} = {whole} AND {quotient} % 2 = 1) THEN 1 ELSE 0 END"
    return f"CAST({quotient} + {up} AS DOUBLE) / 100.0"


def printed_pct(part: str, whole: str) -> str:
    """The same from floating point numbers, rounded as they print."""
    return f"CAST(format('{{:.2f}}', CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100) AS DOUBLE)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def _as_doubles(name: str, prefix: str = "") -> str:
    return ", ".join(f"{dbl(c)} AS {c}" if c in MONEY_COLUMNS else c for c in RAW_COLUMNS[name])


M1_COLUMNS = f"""customer_id, customer_name, month_year, {dbl('annual_income')} AS annual_income, credit_score,
    {big('bank_transactions_count')} AS bank_transactions_count, {dbl('total_income_credits')} AS total_income_credits,
    {dbl('total_expense_debits')} AS total_expense_debits, {dbl('net_cashflow')} AS net_cashflow,
    {dbl('total_card_spend')} AS total_card_spend, {big('card_fraud_count')} AS card_fraud_count,
    {dbl('outstanding_loan_balance')} AS outstanding_loan_balance"""

C360_COLUMNS = f"""customer_id, name, gender, city, state, email, occupation, {dbl('annual_income')} AS annual_income,
    credit_score, join_date, {big('total_accounts')} AS total_accounts, {dbl('total_deposit_balance')} AS total_deposit_balance,
    {big('total_loans')} AS total_loans, {dbl('active_loan_amount')} AS active_loan_amount, {big('total_cards')} AS total_cards,
    {dbl('total_credit_limit')} AS total_credit_limit, {big('lifetime_transactions')} AS lifetime_transactions,
    {dbl('lifetime_transaction_volume')} AS lifetime_transaction_volume, customer_segment"""


def _grouped(table: str, by: str, measure: str, n: str, total: str, avg: str, where: str = "", order: str = "") -> str:
    return (
        f"SELECT {by}, count(*) AS {n}, {dbl(f'sum({measure})')} AS {total}, {avg_money(measure)} AS {avg} "
        f"FROM {table} {where} GROUP BY ALL {order}"
    )


def _analytics() -> dict[str, str]:
    r = registry
    return {
        "q01_top_customers_by_volume": f"""SELECT customer_id, name, city, {dbl('annual_income')} AS annual_income,
            {dbl('lifetime_transaction_volume')} AS lifetime_transaction_volume FROM customer_360
            ORDER BY lifetime_transaction_volume DESC NULLS FIRST, customer_id LIMIT 10""",
        "q02_monthly_txn_trend": _grouped(
            "(SELECT strftime(txn_date, '%Y-%m') AS txn_month, amount FROM transactions)", "txn_month", "amount",
            "transaction_count", "total_volume", "avg_ticket_size"),
        "q03_loan_portfolio_by_type": f"""SELECT loan_type, count(*) AS total_loans, {dbl('sum(loan_amount)')} AS
            total_principal_disbursed, {avg_money('interest_rate')} AS avg_interest_rate, {avg_money('loan_amount')} AS
            avg_ticket_size FROM loans GROUP BY ALL""",
        "q04_loan_status_share": f"""SELECT status AS loan_status, count(*) AS loan_count,
            {pct('count(*)', '(SELECT count(*) FROM loans)')} AS pct_of_portfolio, {dbl('sum(loan_amount)')} AS total_exposure
            FROM loans GROUP BY status""",
        "q05_deposits_by_branch": _grouped(
            "accounts", "branch_id", "balance", "total_accounts", "total_branch_deposits", "avg_account_balance",
            order="ORDER BY sum(balance) DESC NULLS FIRST, branch_id LIMIT 15"),
        "q06_dormant_high_balance": f"""SELECT account_id, customer_id, branch_id, account_type, {dbl('balance')} AS balance,
            open_date FROM accounts a WHERE status = 'Dormant' AND balance > 50000
            ORDER BY a.balance DESC NULLS FIRST, account_id LIMIT 20""",
        "q07_multi_loan_customers": f"""SELECT c.customer_id, c.name, {dbl('c.annual_income')} AS annual_income,
            count(*) AS active_loan_count, {dbl('sum(l.loan_amount)')} AS total_borrowed
            FROM customers c JOIN loans l USING (customer_id) WHERE l.status = 'Active'
            GROUP BY c.customer_id, c.name, c.annual_income HAVING count(*) > 1
            ORDER BY count(*) DESC, sum(l.loan_amount) DESC, c.customer_id LIMIT 20""",
        "q08_merchant_spend": _grouped(
            "card_transactions", "merchant_category", "amount", "transaction_count", "total_spend", "avg_spend"),
        "q09_fraud_by_merchant": f"""SELECT merchant_category, count(*) AS total_txns, {big('sum(is_fraud)')} AS
            fraudulent_txns, {pct('sum(is_fraud)', 'count(*)', 3)} AS fraud_rate_pct,
            {dbl('sum(CASE WHEN is_fraud = 1 THEN amount ELSE 0 END)')} AS total_fraud_loss
            FROM card_transactions GROUP BY ALL""",
        "q10_late_payment_rate": f"""SELECT loan_type, count(*) AS total_installments_paid,
            {big('sum(late_payment_flag)')} AS late_installments_count,
            {pct('sum(late_payment_flag)', 'count(*)')} AS delinquency_rate_pct
            FROM loan_payments JOIN loans USING (loan_id) GROUP BY loan_type""",
        "q11_segment_breakdown": f"""SELECT customer_segment, count(*) AS customer_count,
            {avg_money('annual_income')} AS avg_annual_income, {avg_money('total_deposit_balance')} AS avg_deposit_balance,
            {ratio('sum(credit_score)', 'count(credit_score)', 1)} AS avg_credit_score FROM customer_360 GROUP BY ALL""",
        "q12_channel_velocity": _grouped(
            "transactions", "channel", "amount", "txn_count", "total_volume", "avg_transaction_value"),
        "q13_credit_card_tiers": _grouped(
            "cards", "card_type", "credit_limit", "card_count", "total_credit_exposure", "avg_credit_limit",
            where="WHERE card_type LIKE 'Credit%'"),
        "q14_high_net_worth": f"""SELECT customer_id, name, {dbl('annual_income')} AS annual_income,
            {dbl('total_deposit_balance')} AS total_deposit_balance,
            {ratio('CAST(total_deposit_balance * 100 AS BIGINT)', 'CAST(c.annual_income * 100 AS BIGINT)', 2)} AS balance_to_income_ratio
            FROM customer_360 c WHERE c.annual_income > 1000000
            ORDER BY c.total_deposit_balance DESC NULLS FIRST, customer_id LIMIT 10""",
        "q15_interest_yield_by_year": f"""SELECT strftime(payment_date, '%Y') AS payment_year,
            {dbl('sum(amount_paid)')} AS total_collections, {dbl('sum(principal_component)')} AS total_principal_recovered,
            {dbl('sum(interest_component)')} AS total_interest_earned,
            {pct(cents('interest_component'), cents('amount_paid'))} AS interest_yield_pct
            FROM loan_payments GROUP BY ALL""",
        "q16_account_type_mix": _grouped("accounts", "account_type", "balance", "account_count", "total_balance", "avg_balance"),
        "q17_branch_deposits_vs_loans": f"""SELECT a.branch_id, {dbl('sum(DISTINCT a.balance)')} AS total_deposits,
            {dbl('coalesce(sum(DISTINCT l.loan_amount), 0)')} AS total_loans_issued
            FROM accounts a LEFT JOIN loans l ON a.branch_id = l.branch_id GROUP BY a.branch_id
            ORDER BY sum(DISTINCT a.balance) DESC, a.branch_id LIMIT 15""",
        "q17_exact": f"""SELECT a.branch_id, {dbl('sum(a.balance)')} AS total_deposits, {dbl('''coalesce((SELECT
            sum(loan_amount) FROM loans l WHERE l.branch_id = a.branch_id), 0)''')} AS total_loans_issued
            FROM accounts a GROUP BY a.branch_id ORDER BY sum(a.balance) DESC, a.branch_id LIMIT 15""",
        "q18_fraud_victims": f"""SELECT c.customer_id, c.name, c.city, count(*) AS fraudulent_events,
            {dbl('sum(t.amount)')} AS total_fraud_amount
            FROM card_transactions t JOIN cards k USING (card_id) JOIN customers c ON c.customer_id = k.customer_id
            WHERE t.is_fraud = 1 GROUP BY c.customer_id, c.name, c.city
            ORDER BY sum(t.amount) DESC, c.customer_id LIMIT 15""",
        "q19_monthly_surplus": f"""SELECT customer_id, customer_name, month_year,
            {dbl('total_income_credits')} AS total_income_credits, {dbl('total_expense_debits')} AS total_expense_debits,
            {dbl('net_cashflow')} AS net_cashflow FROM mcs m WHERE m.net_cashflow > 100000
            ORDER BY m.net_cashflow DESC, customer_id, month_year LIMIT 15""",
        "q20_credit_tier_default_rate": f"""SELECT CASE WHEN credit_score >= 750 THEN 'Excellent (750-850)'
            WHEN credit_score >= 650 THEN 'Good (650-749)' WHEN credit_score >= 550 THEN 'Fair (550-649)'
            ELSE 'Poor (< 550)' END AS credit_tier, count(*) AS total_loans,
            count(*) FILTER (status IN ('Defaulted', 'Written Off')) AS defaulted_loans,
            {pct("count(*) FILTER (status IN ('Defaulted', 'Written Off'))", 'count(*)')} AS default_rate_pct
            FROM loans JOIN customers USING (customer_id) GROUP BY credit_tier""",
        "q21_daily_channel_peaks": f"""SELECT txn_date, channel, count(*) AS daily_txns, {dbl('sum(amount)')} AS daily_amount
            FROM transactions GROUP BY ALL ORDER BY sum(amount) DESC, txn_date, channel LIMIT 10""",
        "q22_cards_expiring": f"""SELECT card_id, customer_id, card_type, expiry_date, status FROM cards
            WHERE status = 'Active' AND expiry_date BETWEEN DATE '{r.EXPIRY[0]}' AND DATE '{r.EXPIRY[1]}'
            ORDER BY expiry_date, card_id LIMIT 15""",
        "q23_deposits_by_state": f"""SELECT state, count(DISTINCT customer_id) AS customer_count,
            {dbl('sum(total_deposit_balance)')} AS aggregate_state_deposits,
            {avg_money('total_deposit_balance')} AS avg_deposits_per_customer FROM customer_360 GROUP BY state
            ORDER BY sum(total_deposit_balance) DESC, state LIMIT 10""",
        "q24_age_cohort_channel": f"""SELECT CASE WHEN age < 30 THEN 'Gen Z (< 30)' WHEN age < 50 THEN 'Millennials (30-49)'
            ELSE 'Seniors (50+)' END AS age_cohort, channel, count(*) AS txn_count, {dbl('sum(amount)')} AS total_channel_spend
            FROM transactions JOIN accounts USING (account_id) JOIN (SELECT customer_id,
              date_part('year', age(DATE '{r.AS_OF}', date_of_birth)) AS age FROM customers) USING (customer_id)
            GROUP BY age_cohort, channel""",
        "q25_bank_kpis": f"""SELECT (SELECT count(*) FROM customers) AS total_curated_customers,
            (SELECT count(*) FROM accounts) AS total_curated_accounts,
            (SELECT {dbl('sum(balance)')} FROM accounts) AS total_deposit_holdings,
            (SELECT count(*) FROM loans WHERE status = 'Active') AS total_active_loans,
            (SELECT {dbl('sum(loan_amount)')} FROM loans WHERE status = 'Active') AS active_loan_portfolio,
            (SELECT count(*) FROM cards WHERE status = 'Active') AS active_cards,
            (SELECT count(*) FROM transactions) AS lifetime_transactions_recorded,
            (SELECT count(*) FROM card_transactions) AS lifetime_card_transactions_recorded""",
    }


def _reads() -> dict[str, str]:
    customer = registry.DETAIL_CUSTOMER
    return {
        "o1_list_customers": f"""SELECT customer_id, name, gender, city, state, email, occupation,
            {dbl('annual_income')} AS annual_income, credit_score, join_date FROM customers
            WHERE lower(city) = lower('{registry.LIST_CITY}') ORDER BY customer_id LIMIT 20 OFFSET 5""",
        "o2_customer_detail": " UNION ALL BY NAME ".join(
            f"SELECT '{name}' AS section, {columns} FROM {name} WHERE customer_id = {customer}"
            for name, columns in (
                ("customers", _as_doubles("customers")), ("customer_360", C360_COLUMNS), ("accounts", _as_doubles("accounts")),
                ("loans", _as_doubles("loans")), ("cards", _as_doubles("cards")),
            )
        ),
        "o3_list_accounts": f"""SELECT {_as_doubles('accounts')} FROM accounts WHERE lower(account_type) = 'fixed deposit'
            ORDER BY account_id LIMIT 100 OFFSET 10""",
        "o4_list_transactions": f"""SELECT {_as_doubles('transactions')} FROM transactions
            ORDER BY txn_date DESC, transaction_id DESC LIMIT 200 OFFSET 50""",
        "o4_list_transactions_deep": f"""SELECT {_as_doubles('transactions')} FROM transactions
            ORDER BY txn_date DESC, transaction_id DESC LIMIT 200 OFFSET {registry.DEEP_OFFSET}""",
        "o5_list_loans": f"""SELECT {_as_doubles('loans')} FROM loans WHERE lower(status) = 'active' ORDER BY loan_id LIMIT 50""",
        "o6_list_cards": f"""SELECT {_as_doubles('cards')} FROM cards WHERE lower(card_type) = 'credit - gold'
            ORDER BY card_id LIMIT 150""",
        "o7_list_customer_360": f"""SELECT {C360_COLUMNS} FROM customer_360 c WHERE customer_segment ILIKE '%low risk%'
            ORDER BY c.total_deposit_balance DESC, customer_id LIMIT 60""",
        "o7_list_customer_360_by_key": f"""SELECT {C360_COLUMNS} FROM customer_360 c WHERE customer_segment ILIKE '%low risk%'
            ORDER BY c.total_deposit_balance DESC, customer_id LIMIT 50 OFFSET 10""",
        "o8_dashboard_kpis": f"""SELECT (SELECT count(*) FROM customers) AS total_customers,
            (SELECT count(*) FROM accounts) AS total_accounts, (SELECT {dbl('sum(balance)')} FROM accounts) AS total_deposits,
            (SELECT count(*) FROM loans WHERE status = 'Active') AS total_active_loans,
            (SELECT {dbl('sum(loan_amount)')} FROM loans WHERE status = 'Active') AS active_loan_portfolio,
            (SELECT count(*) FROM cards WHERE status = 'Active') AS active_cards,
            (SELECT count(*) FROM transactions) AS lifetime_transactions,
            (SELECT count(*) FROM card_transactions) AS lifetime_card_transactions,
            (SELECT {big('sum(is_fraud)')} FROM card_transactions) AS total_fraud_transactions""",
        "o9_segment_counts": "SELECT customer_segment, count(*) AS count FROM customer_360 GROUP BY ALL",
    }


FOREIGN_KEYS = [
    ("employees", "branch_id", "branches"), ("accounts", "customer_id", "customers"), ("accounts", "branch_id", "branches"),
    ("transactions", "account_id", "accounts"), ("loans", "customer_id", "customers"), ("loans", "branch_id", "branches"),
    ("loan_payments", "loan_id", "loans"), ("cards", "customer_id", "customers"), ("cards", "account_id", "accounts"),
    ("card_transactions", "card_id", "cards"), ("support_tickets", "customer_id", "customers"),
]

# Column, whether a value is required, longest text, condition; one line per constrained column.
CONSTRAINTS = {
    "branches": [("branch_id", True, 0, ""), ("branch_name", True, 150, ""), ("city", True, 100, ""),
                 ("state", True, 100, ""), ("ifsc_code", True, 30, "")],
    "employees": [("employee_id", True, 0, ""), ("name", True, 150, ""), ("branch_id", True, 0, ""),
                  ("role", True, 100, ""), ("salary", True, 0, "salary > 0")],
    "customers": [("customer_id", True, 0, ""), ("name", True, 150, ""), ("gender", False, 20, ""), ("city", False, 100, ""),
                  ("state", False, 100, ""), ("phone", False, 30, ""), ("email", True, 150, ""),
                  ("occupation", False, 100, ""), ("annual_income", False, 0, "annual_income > 0"),
                  ("credit_score", False, 0, "credit_score BETWEEN 300 AND 850")],
    "accounts": [("account_id", True, 0, ""), ("customer_id", True, 0, ""), ("branch_id", True, 0, ""),
                 ("account_type", True, 50, ""), ("balance", True, 0, "balance >= 0"), ("status", True, 30, "")],
    "transactions": [("transaction_id", True, 0, ""), ("account_id", True, 0, ""), ("txn_date", True, 0, ""),
                     ("txn_type", True, 50, ""), ("amount", True, 0, "amount > 0"), ("channel", False, 50, ""),
                     ("merchant_category", False, 100, "")],
    "loans": [("loan_id", True, 0, ""), ("customer_id", True, 0, ""), ("branch_id", True, 0, ""), ("loan_type", True, 50, ""),
              ("loan_amount", True, 0, "loan_amount > 0"), ("interest_rate", True, 0, ""),
              ("term_months", True, 0, "term_months > 0"), ("start_date", True, 0, ""), ("status", True, 30, "")],
    "loan_payments": [("payment_id", True, 0, ""), ("loan_id", True, 0, ""), ("payment_date", True, 0, ""),
                      ("amount_paid", True, 0, "amount_paid > 0"), ("principal_component", True, 0, ""),
                      ("interest_component", True, 0, ""), ("late_payment_flag", True, 0, "late_payment_flag IN (0, 1)")],
    "cards": [("card_id", True, 0, ""), ("customer_id", True, 0, ""), ("account_id", True, 0, ""), ("card_type", True, 50, ""),
              ("issue_date", True, 0, ""), ("expiry_date", True, 0, ""), ("credit_limit", True, 0, "credit_limit >= 0"),
              ("status", True, 30, "")],
    "card_transactions": [("card_txn_id", True, 0, ""), ("card_id", True, 0, ""), ("txn_date", True, 0, ""),
                          ("merchant_category", True, 100, ""), ("amount", True, 0, "amount > 0"),
                          ("is_fraud", True, 0, "is_fraud IN (0, 1)")],
    "support_tickets": [("ticket_id", True, 0, ""), ("customer_id", True, 0, ""), ("issue_type", True, 100, ""),
                        ("date_opened", True, 0, ""), ("status", True, 30, ""),
                        ("satisfaction_score", False, 0, "satisfaction_score BETWEEN 1 AND 5")],
}


def _constraint_rows(prefix: str) -> str:
    rows = []
    for name, columns in CONSTRAINTS.items():
        for column, required, length, check in columns:
            tests = [("not_null", f"{column} IS NULL")] if required else []
            tests += [("max_length", f"length({column}) > {length}")] if length else []
            tests += [("check", f"NOT ({check})")] if check else []
            rows += [
                f"SELECT '{name}' AS table_name, '{column}' AS column_name, '{label}' AS constraint_name, "
                f"count(*) AS violations FROM {prefix}{name} WHERE {test}"
                for label, test in tests
            ]
    return " UNION ALL ".join(rows)


def _fk_rows(prefix: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS fk_column, '{p}' AS parent_table, count(*) AS orphan_count "
        f"FROM {prefix}{t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {KEYS[p][0]} FROM {p})"
        for t, c, p in FOREIGN_KEYS
    )


def _pk_rows(prefix: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, (SELECT count(*) FROM (SELECT {k} FROM {prefix}{n} WHERE {k} IS NOT NULL "
        f"GROUP BY {k} HAVING count(*) > 1)) AS duplicate_keys, "
        f"(SELECT count(*) FROM {prefix}{n} WHERE {k} IS NULL) AS missing_keys"
        for n, (k, _) in KEYS.items()
    )


def _counts(pairs) -> str:
    return " UNION ALL ".join(f"SELECT '{label}' AS table_name, count(*) AS row_count FROM {t}" for label, t in pairs)


def _rates(good: str, bad: str, total: str, rate=printed_pct) -> str:
    return f"{rate(good, total)} AS success_rate_pct, {rate(bad, total)} AS failure_rate_pct"


def _summary(names) -> str:
    return (
        "SELECT 'process_' || table_name AS pipeline_name, 'SUCCESS' AS status, total_records, curated_records, "
        f"bad_records, {_rates('curated_records', 'bad_records', 'total_records')} FROM ("
        + " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, (SELECT count(*) FROM raw_{n}) AS total_records, "
            f"(SELECT count(*) FROM {n}) AS curated_records, (SELECT count(*) FROM bad_{n}) AS bad_records"
            for n in names
        )
        + ")"
    )


LAKE = ("branches", "employees", "customers", "accounts", "transactions")


def _csv_text(x: str) -> str:
    """A raw text after it went through a CSV file: texts that mean no value are gone."""
    return f"CASE WHEN {x} NOT IN ('', 'NaN') THEN {strip(x)} END"


def _sources() -> dict[str, str]:
    read = {n: f"SELECT {', '.join(f'{_csv_text(c)} AS {c}' for c in RAW_COLUMNS[n])} FROM raw_{n}" for n in NAMES}
    totals = "sum(total_records)", "sum(curated_records)", "sum(bad_records)"
    run_totals = (
        "SELECT 'all tables' AS pipeline_name, 'SUCCESS' AS status, "
        + ", ".join(f"{big(t)} AS {c}" for t, c in zip(totals, ("total_records", "curated_records", "bad_records")))
        + f", {_rates('sum(curated_records)', 'sum(bad_records)', 'sum(total_records)')} FROM ({_summary(NAMES)})"
    )
    reasons = _reports()["p2_top_reasons"]
    skipped = [n for n in LAKE if n not in ("accounts", "transactions")]
    return {
        "a1_read_raw": read["customers"],
        "a1_damaged_lines": _damaged_lines(),
        "a1_curate_damaged": _curate_damaged(),
        "a2_read_large": read["transactions"],
        "a2_read_large_loan_payments": read["loan_payments"],
        "a2_read_large_card_transactions": read["card_transactions"],
        "a3_read_parent_keys": "SELECT account_id FROM accounts",
        "a4_require_parents": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, '{p}' AS parent, 'curated {p} needed before {name}' AS refusal, "
            f"count(*) AS parent_keys, false AS written FROM {p}"
            for name, parents in PARENTS.items()
            for p in parents
        ),
        "a5_write_curated_and_quarantine": _counts([("curated", "cards"), ("quarantine", "bad_cards")]),
        "a6_empty_output": f"""SELECT 'quarantine' AS zone, count(*) AS n, count(transaction_id) AS with_id
            FROM raw_transactions HAVING count(*) > 0""",
        "a6_three_batches": """SELECT table_name, rejection_reason, validation_stage, count(*) AS n FROM rejected GROUP BY ALL
            UNION ALL SELECT table_name, NULL, NULL, curated_records FROM verdicts""",
        "a7_skip_missing": _counts(
            [(f"silver/{n}", n) for n in skipped] + [(f"quarantine/{n}", f"bad_{n}") for n in skipped]
            + [("silver/transactions", "raw_transactions WHERE false"), ("quarantine/transactions", "raw_transactions")]
        ),
        "a9_lake_curation": _counts([(f"silver/{n}", n) for n in LAKE] + [(f"quarantine/{n}", f"bad_{n}") for n in LAKE]),
        "a10_staged_publish": _counts([(n, n) for n in NAMES]),
        "a11_fk_audit": _fk_rows(""),
        "a11_fk_audit_raw": _fk_rows("all_"),
        "a12_constraint_audit": _constraint_rows(""),
        "a12_constraint_audit_raw": _constraint_rows("all_"),
        "a13_pk_audit": _pk_rows(""),
        "a13_pk_audit_raw": _pk_rows("all_"),
        "a14_table_counts": _counts([(n, n) for n in NAMES]),
        "a15_build_mart": _counts([
            ("monthly_customer_summary", "mcs"), ("monthly_customer_summary_full", "mcs_full"),
            ("monthly_branch_summary", "mbs"), ("customer_360", "customer_360"),
        ]),
        "a17_run_log": f"SELECT t.*, r.table_name, r.rejection_reason, r.n FROM ({run_totals}) t CROSS JOIN ({reasons}) r",
    }


def _cascade(name: str) -> str:
    links = [(c, p) for t, c, p in FOREIGN_KEYS if t == name and any(r[0] == f"orphan_key:{c}" for r in RULES[name])]
    position = {r[0]: i for i, r in enumerate(RULES[name])}
    orphans = [f"b{position[f'orphan_key:{c}']}" for c, _ in links]
    lost = [
        f"({o} AND coalesce(({ref(c)}) NOT IN (SELECT k FROM (SELECT {ref(KEYS[p][0])} AS k FROM bad_{p}) WHERE k IS NOT NULL), true))"
        for o, (c, p) in zip(orphans, links)
    ]
    others = " OR ".join(f"b{i}" for i, r in enumerate(RULES[name]) if r[1] != RI)
    return (
        f"SELECT '{name}' AS table_name, count(*) FILTER (o AND NOT t AND NOT x) AS cascaded, "
        f"count(*) FILTER (o AND NOT t AND x) AS cascaded_with_other_faults, count(*) FILTER (t) AS true_orphans "
        f"FROM (SELECT ({' OR '.join(orphans)}) AS o, ({' OR '.join(lost)}) AS t, ({others}) AS x FROM judged_{name})"
    )


def _reports() -> dict[str, str]:
    duplicates = " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, {pk(k)} AS key, CASE WHEN ({pk(k)}) IS NULL AND {strip(k)} <> '' THEN {strip(k)} END "
        f"AS key_text, count(*) AS copies FROM raw_{n} GROUP BY ALL HAVING count(*) > 1"
        for n, (k, _) in KEYS.items()
    )
    first = "(SELECT {c} FROM broken b WHERE b.table_name = v.table_name GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
    children = [n for n in NAMES if n not in ("branches", "customers")]
    return {
        "e9_duplicate_keys": duplicates,
        "e11_run_totals": "SELECT " + ", ".join(
            f"{big(f'sum({c})')} AS {c}" for c in ("total_records", "curated_records", "bad_records")
        ) + f", {_rates('sum(curated_records)', 'sum(bad_records)', 'sum(total_records)', half_even_pct)} FROM verdicts",
        "h1_all_quarantine": "SELECT table_name, validation_stage, count(*) AS n FROM rejected GROUP BY ALL",
        "p1_quality_report": f"""SELECT v.table_name, {big('total_records')} AS total_records,
            {big('curated_records')} AS curated_records, {big('bad_records')} AS bad_records,
            {half_even_pct('curated_records', 'total_records')} AS pass_rate_pct, {first.format(c='stage')} AS main_stage,
            {first.format(c='rule')} AS top_rule
            FROM (SELECT * FROM verdicts UNION ALL SELECT 'TOTAL', sum(total_records), sum(curated_records),
                  sum(bad_records) FROM verdicts) v""",
        "p2_top_reasons": """SELECT table_name, rejection_reason, n, CAST(rank AS INTEGER) AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY n DESC, rejection_reason) AS rank FROM (
              SELECT table_name, rejection_reason, count(*) AS n FROM rejected GROUP BY ALL)) WHERE rank <= 3""",
        "p3_reason_breakdown": "SELECT table_name, rule, stage, count(*) AS n FROM broken GROUP BY ALL",
        "p4_cascade_report": " UNION ALL ".join(_cascade(n) for n in children),
        "p5_redact": _redaction("documents", "doc_id"),
        "p5_redact_conversations": _redaction("conversations", "conv_id", "turn"),
    }


def _redaction(table: str, *keys: str) -> str:
    secret = f"CAST({keys[0]} AS VARCHAR)"
    text = (
        f"text || chr(10) || 'password: pw' || {secret} || ', Token=' || {secret} || '; API-key:  k-' || {secret} || "
        f"' secret=s3cr3t&aws_secret_access_key=AK' || {secret} || ' postgresql://svc:p' || {secret} || "
        f"'@db/bank POSTGRES://u:q' || {secret} || '@h'"
    )
    for word in ("password", "secret", "token", "api[-_]?key", "aws_secret_access_key"):
        text = f"regexp_replace({text}, '({word}[:=]\\s*)([^\\s,;&]+)', '\\1[REDACTED]', 'gi')"
    for scheme in ("postgres", "postgresql"):
        text = f"regexp_replace({text}, '({scheme}://[^\\s:]+:)([^@]+)(@)', '\\1[REDACTED]\\3', 'gi')"
    return f"SELECT {', '.join(keys)}, {text} AS redacted FROM {table}"


def _events() -> dict[str, str]:
    high = registry.HIGH_VALUE
    flagged = f"""SELECT event_id AS transaction_id, user_id AS account_id, value AS amount, event_type AS channel,
        (value >= {high} OR value <= 0) AS is_flagged, CASE WHEN value >= {high} THEN 'HIGH_VALUE_TRANSACTION_ALERT'
        WHEN value <= 0 THEN 'INVALID_ZERO_OR_NEGATIVE_AMOUNT' ELSE 'NORMAL' END AS risk_reason FROM events"""
    sums = f"count(*) AS events, {dbl('sum(CAST(value AS DECIMAL(15,2)))')} AS amount"

    def sliding(key: str, alias: str) -> str:
        return f"""SELECT w AS window_start, w + INTERVAL 5 MINUTE AS window_end, {key} AS {alias}, {sums}
            FROM (SELECT *, unnest([time_bucket(INTERVAL 1 MINUTE, ts) - INTERVAL 1 MINUTE * i FOR i IN range(5)]) AS w FROM events)
            GROUP BY w, {key}"""

    return {
        "j1_flag_events": flagged,
        "j2_route_events": f"SELECT * FROM ({flagged}) WHERE is_flagged",
        "j3_stream_summary": f"""SELECT count(*) AS processed, count(*) FILTER (NOT is_flagged) AS clean,
            count(*) FILTER (is_flagged) AS flagged FROM ({flagged})""",
        "s1_tumbling_5m": f"""SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
            time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end, event_type AS channel, {sums}
            FROM events GROUP BY ALL""",
        "s2_sliding_5m": sliding("event_type", "channel"),
        "s3_velocity_alert": f"SELECT * FROM ({sliding('user_id', 'account_id')}) WHERE events >= {registry.VELOCITY_EVENTS}",
        "s3_velocity_bursts": f"""SELECT user_id AS account_id, min(ts) AS burst_start, max(ts) AS burst_end, {sums}
            FROM (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS burst FROM (
              SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 5 MINUTE THEN 0
                ELSE 1 END AS first FROM events))
            GROUP BY user_id, burst HAVING count(*) >= {registry.VELOCITY_EVENTS} AND max(ts) + INTERVAL 5 MINUTE <=
              (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)""",
        "s4_late_data": f"""SELECT * FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
            time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end, event_type AS channel, {sums}
            FROM events GROUP BY ALL)
            WHERE window_end <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)""",
        "s5_event_dedup": """SELECT event_id AS transaction_id, user_id AS account_id, value AS amount, event_type AS channel
            FROM events""",
        "s6_incremental_merge": f"""SELECT account_id, changed_on, change_id, {dbl('amount')} AS amount FROM (
            SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY changed_on DESC, change_id DESC) AS rn FROM (
              SELECT account_id, open_date AS changed_on, CAST(0 AS BIGINT) AS change_id, balance AS amount FROM accounts
              UNION ALL SELECT account_id, txn_date, transaction_id, amount FROM transactions)) WHERE rn = 1""",
        "s7_partitioned_publish": "SELECT strftime(txn_date, '%Y-%m') AS month, count(*) AS n FROM transactions GROUP BY ALL",
        "s9_mask_pii": f"""SELECT {', '.join({
            'email': "'***@' || split_part(email, '@', 2) AS email", 'phone': "'******' || right(phone, 2) AS phone",
            'annual_income': 'CAST(NULL AS DOUBLE) AS annual_income'}.get(c, c) for c in RAW_COLUMNS['customers'])}
            FROM customers""",
    }


def oracle_sql() -> dict[str, str]:
    bodies = {}
    for name in ("o1_list_customers", "o4_list_transactions"):  # a page by key is the page by offset
        bodies[f"{name}_by_key"] = _reads()[name]
    for number, name in enumerate(NAMES, 1):
        bodies[f"c{number}_validate_{name}"] = f"SELECT * FROM bad_{name}"
        bodies[f"i{number}_transform_{name}"] = f"SELECT {_as_doubles(name)} FROM {name}"
        bodies[f"l{number}_curate_{name}"] = _summary([name])
    bodies["l11_curate_all"] = _summary(NAMES)
    bodies["m1_monthly_customer_summary"] = f"SELECT {M1_COLUMNS} FROM mcs"
    bodies["m1b_monthly_customer_summary_full"] = f"SELECT {M1_COLUMNS} FROM mcs_full"
    bodies["m2_monthly_branch_summary"] = f"""SELECT branch_id, month_year, active_customers, total_accounts,
        total_transactions, {dbl('total_volume')} AS total_volume, {dbl('deposit_volume')} AS deposit_volume,
        {dbl('withdrawal_volume')} AS withdrawal_volume FROM mbs"""
    bodies["m3_customer_360"] = f"SELECT {C360_COLUMNS} FROM customer_360"
    for group in (_sources(), _reports(), _analytics(), _reads(), _events()):
        bodies.update(group)
    for name, same in (
        ("a15_additive_customer_months", "m1_monthly_customer_summary"),
        ("a15_additive_branch_months", "m2_monthly_branch_summary"),
        ("a15_additive_customer_360", "m3_customer_360"),
        ("s6_copy_on_write_merge", "s6_incremental_merge"),
    ):  # how a result was brought up to date doesn't show in it
        bodies[name] = bodies[same]
    return {name: _with(body) for name, body in bodies.items()}
