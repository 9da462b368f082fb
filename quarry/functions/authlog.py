"""sshd message fields as column expressions.

Fixed values (the message texts recognised):
  accepted:  "Accepted password for"
  failed:    "Failed password for"
  invalid:   "Failed password for invalid user"
  repeated:  "message repeated <n> time"
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ACCEPTED = "Accepted password for"
FAILED = "Failed password for"
FAILED_INVALID = "Failed password for invalid user"

# Account text between the first "for " and the first " from ".
_FOR_FROM = r"for (.*?) ?from "
_INVALID = r"invalid user (.*?) ?from "
_REPEATED = r"message repeated (\d+) time"
# Anchored source address: the token between "from " and " port".
_IP = r"from (\S+) port"


def day_key(line: Column) -> Column:
    """First six characters of the syslog prefix (``Dec 10``, ``Dec  1``)."""
    return F.substring(line, 1, 6)


def attempt_weight(line: Column) -> Column:
    """Accepted -> 1; ``message repeated n times`` -> n; otherwise 1
    (also where n does not fit 64 bits)."""
    rep = F.regexp_extract(line, _REPEATED, 1)
    return (F.when(line.contains(ACCEPTED), F.lit(1))
            .when(line.contains("message repeated") & (rep != ""), F.coalesce(rep.try_cast("bigint"), F.lit(1).cast("bigint")))
            .otherwise(F.lit(1).cast("bigint"))).cast("bigint")


def account(line: Column) -> Column:
    """Text between the first ``for`` and ``from``; for an invalid user the
    first word after ``invalid user`` (NULL when empty), else the last word."""
    s = F.trim(F.regexp_extract(line, _FOR_FROM, 1))
    inv = F.trim(F.regexp_extract(s, r"invalid user(.*)$", 1))
    first_word = F.nullif(F.element_at(F.split(inv, r"\s+"), 1), F.lit(""))
    last_word = F.element_at(F.split(s, r"\s+"), -1)
    return F.when(s.contains("invalid user"), first_word).otherwise(last_word)


def invalid_account(line: Column) -> Column:
    """Whole text between ``invalid user`` and ``from``, trimmed; may be ''."""
    return F.trim(F.regexp_extract(line, _INVALID, 1))


def source_ip(line: Column) -> Column:
    return F.regexp_extract(line, _IP, 1)
