"""Access-log lines as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the layout of an access-log line (address, identity, user, time, request,
# status, bytes, referrer, agent, anything).
ACCESS_LOG = (r'^([\d.]+) (\S+) (\S+) \[([\w\d:/]+\s[+\-]\d{4})\] "(.+?)" (\d{3}) ([\d\-]+) '
              r'"([^"]+)" "([^"]+)".*')
FIELDS = ("ip", "identity", "user", "time", "request", "status", "bytes", "referer", "agent")
ANONYMOUS = '"-"'


_MARK = "\x01"


def access_log(line: Column) -> Column:
    """The nine fields of a line as a struct of strings; null when the line does not match.

    The pattern runs once per line: it rewrites the line as its fields between marks. Lines
    that hold a mark themselves are taken apart group by group.
    """
    groups = _MARK.join(f"${i + 1}" for i in range(len(FIELDS)))
    marked = F.split(F.regexp_replace(line, ACCESS_LOG, groups), _MARK, -1)
    fast = F.transform(F.array(marked), lambda p: F.when(
        F.size(p) == len(FIELDS), F.struct(*[p[i].alias(n) for i, n in enumerate(FIELDS)])))[0]
    slow = F.when(line.rlike(ACCESS_LOG), F.struct(
        *[F.regexp_extract(line, ACCESS_LOG, i + 1).alias(n) for i, n in enumerate(FIELDS)]))
    return F.when(F.contains(line, F.lit(_MARK)), slow).otherwise(fast)


def visit_key(entry: Column) -> list[Column]:
    """(ip, user, request), all null for unknown users and for lines that do not match."""
    known = entry.isNotNull() & (entry["user"] != ANONYMOUS)
    return [F.when(known, entry[f]).alias(f) for f in ("ip", "user", "request")]


def visit_bytes(entry: Column) -> Column:
    """Bytes sent; 0 when absent, not a number or the line does not match."""
    return F.coalesce(entry["bytes"].try_cast("bigint"), F.lit(0)).alias("bytes")
