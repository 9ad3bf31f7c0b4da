"""Named log formats: a regular expression plus the names of its capture groups.

Patterns are Java regular expressions (Spark evaluates them in the JVM), so they
behave exactly like the original log jobs that used ``java.util.regex``.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LogFormat:
    name: str
    pattern: str
    groups: tuple[str, ...]
    # Groups the original jobs emitted, by 1-based group number (0 = whole match).
    default_groups: tuple[int, ...]

    @property
    def n_groups(self) -> int:
        return len(self.groups)


# ---------------------------------------------------------------------------
# These log formats must match the same lines with the same groups as the
# original jobs' expressions (two of them write a quote with a backslash before it, which
# means the same).
# ---------------------------------------------------------------------------
COMPUTE_LOG = (
    r"([\d*-]*) ([\d*:]*.\d*) (\d*) (\w*) ([\w*\.]*) \[([\w*-]*) ([a-zA-Z0-9]*) "
    r"([a-zA-Z0-9]*).*-\] \[\w*\W\s(.*)\] (.*)(\s*)"
)
AGENT_ERROR_LOG = r"([\d*-]*) ([\d*:]*.\d*) (\d*) ([A-Z]*) ([\w*\.]*.) (.*) (\S)"
API_ACCESS_LOG = (
    r"([(\d*)-]*) ([\d*:]*\.\d*) (\d*) ([A-Z]*) (\S*) (\[)(\S*) (\S*) (\S*) ([\S ]*-]) "
    r"([\d*\.]*\d*) (\"\S*) (\S*)"
)
DASHBOARD_ERROR_LOG = r"(\w* \w* \d*) (\S*) (\d*)] \S* \[\w* (\d*):\w* (\d*)] ((.*))"
DASHBOARD_ACCESS_LOG = (
    r"([(\d*).]*) (- -) (\[[\S*\/]*) (\S*\]) (\S*) (.*) (\S*\/\S*) (\d*) (\d*) (\"\S*) "
    r"(\"\S*) (\(.*) (\S*) (\(\S*, \S* \S*) (\S*) ((\S*))"
)
COMPUTE_LOG_SHORT = r"([\d*-]*) ([\d*:]*.\d*) (\d*) (\w*) ([\w*\.]*) \[([\w*-]*).*\] (.*)(\s*)"
# Phrase that marks a resource-claim message, and the claim's token positions:
# "Attempting claim: memory <M> MB, disk <D> GB, ..." -> words[3] of the first
# comma part, words[2] of the second.
CLAIM_PHRASE = "Attempting claim"
# ---------------------------------------------------------------------------

FORMATS: dict[str, LogFormat] = {
    "compute": LogFormat(
        "compute", COMPUTE_LOG,
        ("date", "time", "pid", "level", "module", "request_id", "user_id",
         "tenant_id", "instance", "message", "trailing"),
        tuple(range(1, 11)),
    ),
    "agent_error": LogFormat(
        "agent_error", AGENT_ERROR_LOG,
        ("date", "time", "pid", "level", "module", "message", "tail"),
        tuple(range(1, 7)),
    ),
    "api_access": LogFormat(
        "api_access", API_ACCESS_LOG,
        ("date", "time", "pid", "level", "module", "bracket", "request_id", "user_id",
         "tenant_id", "context", "client", "method", "path"),
        (4, 5, 7, 8, 9, 11, 12),
    ),
    "dashboard_error": LogFormat(
        "dashboard_error", DASHBOARD_ERROR_LOG,
        ("day", "time", "year", "pid", "tid", "message", "message_body"),
        tuple(range(0, 7)),
    ),
    "dashboard_access": LogFormat(
        "dashboard_access", DASHBOARD_ACCESS_LOG,
        tuple(f"field_{i}" for i in range(1, 18)),
        tuple(range(1, 17)),
    ),
    "compute_short": LogFormat(
        "compute_short", COMPUTE_LOG_SHORT,
        ("date", "time", "pid", "level", "module", "request_id", "message", "trailing"),
        tuple(range(1, 8)),
    ),
}


def get_format(name_or_format: str | LogFormat) -> LogFormat:
    if isinstance(name_or_format, LogFormat):
        return name_or_format
    try:
        return FORMATS[name_or_format]
    except KeyError as e:
        raise ValueError(f"unknown log format {name_or_format!r}; known: {sorted(FORMATS)}") from e
