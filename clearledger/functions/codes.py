"""Code sets: free-text synonyms to codes, and codes to labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearledger.functions.text import lower_trimmed, proper_case, upper_trimmed

# Synonyms (lower case, trimmed) accepted for each code.
BOOLEANS = {
    True: ("yes", "true", "1", "y", "active"),
    False: ("no", "false", "0", "n", "inactive", "closed"),
}
STATES = {
    0: ("active", "open", "1", "yes", "true"),
    1: ("inactive", "closed", "0", "no", "false", "dormant", "matured"),
}
COUNTRIES = {
    "BE": ("be", "bel", "belgium"),
    "NL": ("nl", "nld", "netherlands"),
    "FR": ("fr", "fra", "france"),
    "DE": ("de", "deu", "germany"),
    "GB": ("gb", "gbr", "uk", "united kingdom"),
    "US": ("us", "usa", "united states"),
}
ACCOUNT_TYPES = {
    "Checking": ("checking",),
    "Savings": ("savings",),
    "Business": ("business",),
    "Joint": ("joint",),
    "Student": ("student",),
}
HOLDING_TYPES = {
    104800000: ("deposit", "deposit account"),
    104800001: ("savings", "savings account"),
    104800002: ("current", "current account"),
    104800003: ("loan",),
    104800004: ("credit_line", "line of credit"),
    104800005: ("investment",),
    104800006: ("term_deposit", "term deposit"),
}

# Codes used when no synonym matches (NULL included).
DEFAULT_STATE = 0
DEFAULT_STATUS = 1
DEFAULT_HOLDING_TYPE = 104800000

# Labels of the codes, and the status code that goes with each state.
STATE_LABELS = {0: "Active", 1: "Inactive"}
STATUS_OF_STATE = {0: 1, 1: 2}
STATUS_LABELS = {1: "Active", 2: "Inactive"}
HOLDING_TYPE_LABELS = {
    104800000: "Deposit Account",
    104800001: "Savings Account",
    104800002: "Current Account",
    104800003: "Loan",
    104800004: "Line of Credit",
    104800005: "Investment",
    104800006: "Term Deposit",
}
UNKNOWN_LABEL = "Unknown"


def _looked_up(key: Column, table: Mapping[object, object], default) -> Column:
    """Value of ``key`` in a constant table, ``default`` where it is NULL or unknown.

    A table is one constant and one lookup in the generated code, however many entries it has.
    """
    constant = F.create_map(*[F.lit(x) for entry in table.items() for x in entry])
    found = constant[key] if table else F.lit(None)
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def resolve_codes(text: Column, codes: Mapping[object, Sequence[str]], default=None) -> Column:
    """Code whose synonyms contain the text, ignoring case and surrounding spaces; that of the
    first, if several do.

    ``default`` (a value or a column) stands in for unknown and NULL texts.
    """
    table: dict[str, object] = {}
    for code, synonyms in codes.items():
        for word in synonyms:
            table.setdefault(word, code)
    return _looked_up(lower_trimmed(text), table, default)


def is_listed(text: Column, codes: Mapping[object, Sequence[str]]) -> Column:
    """Whether the text is a synonym of any code; false, never NULL, for a NULL text."""
    synonyms = [word for words in codes.values() for word in words]
    return F.coalesce(lower_trimmed(text).isin(*synonyms), F.lit(False))


def display_codes(code: Column, labels: Mapping[object, object], default) -> Column:
    """Label (or dependent code) of each code."""
    return _looked_up(code, labels, default)


def normalize_boolean(text: Column) -> Column:
    return resolve_codes(text, BOOLEANS, F.lit(None).cast("boolean"))


def resolve_state(text: Column) -> Column:
    return resolve_codes(text, STATES, DEFAULT_STATE)


def state_label(state: Column) -> Column:
    return display_codes(state, STATE_LABELS, UNKNOWN_LABEL)


def status_of_state(state: Column) -> Column:
    return display_codes(state, STATUS_OF_STATE, DEFAULT_STATUS)


def status_label(status: Column) -> Column:
    return display_codes(status, STATUS_LABELS, UNKNOWN_LABEL)


def normalize_country(text: Column) -> Column:
    """Two-letter country code; other texts are only trimmed and upper-cased."""
    return resolve_codes(text, COUNTRIES, upper_trimmed(text))


def resolve_account_type(text: Column) -> Column:
    return resolve_codes(text, ACCOUNT_TYPES, proper_case(text))


def resolve_holding_type(text: Column) -> Column:
    return resolve_codes(text, HOLDING_TYPES, DEFAULT_HOLDING_TYPE)


def holding_type_label(code: Column) -> Column:
    return display_codes(code, HOLDING_TYPE_LABELS, UNKNOWN_LABEL)
