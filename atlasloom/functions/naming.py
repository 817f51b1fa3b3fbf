"""Names, ids and times under which a statistics server's objects are filed, and texts for people."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

MOST_INSTANCE, MOST_PREFIX = 16, 32  # fixed values: lengths that keep ids within 64 characters
_UTC = ("UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z")


def valid_name(text: str, most: int) -> bool:
    return re.fullmatch(r"[A-Za-z0-9-]{1,%d}" % most, text) is not None


@dataclass(frozen=True)
class Instance:
    """The short name of a server, and the systems, ids and addresses that follow from it."""

    name: str
    base: str = "https://registry.example.org"

    def __post_init__(self):
        if not valid_name(self.name, MOST_INSTANCE):
            raise ValueError(f"an instance is at most {MOST_INSTANCE} letters, digits and hyphens: {self.name}")

    def identifier(self, kind: str) -> str:
        """kind: orgunit, indicator, data-element or data-set, or one of these with -code."""
        return f"{self.base}/identifiers/{self.name}/{kind}"

    def group(self, kind: str) -> str:
        """kind: org-unit-group, indicator-group, data-element-group, or data-element-group-set/ID."""
        return f"{self.base}/CodeSystem/{self.name}/{kind}"

    def dimension(self, key: str | None = None) -> str:
        return self.group(f"dimension/{key}" if key else "dimension")

    def measure_id(self, item: str) -> str:
        return f"{self.name}-{fhir_key(item)}"

    def measure_url(self, item: str) -> str:
        return f"{self.base}/Measure/{self.measure_id(item)}"


def fhir_key(item: str) -> str:
    """An item's id as a part of a document's id, which has no underscore."""
    return item.replace("_", "-")


def server_time(text: Column, utc: Column) -> Column:
    """A server's local time as a dateTime: with a zone if it has one or the server runs on UTC, else the date alone; null if it is none."""
    day = F.substring(text, 1, 10)
    timed = (F.length(text) >= 19) & (F.substring(text, 11, 1) == "T") & utc
    zoned = F.substring(text, 20, 40).rlike("[Z+-]")
    return F.when(~text.rlike(r"^[0-9]{4}-..-.."), None).when(~timed, day).when(zoned, text).otherwise(F.concat(text, F.lit("Z")))


def runs_on_utc(zone: Column) -> Column:
    return F.coalesce(zone, F.lit("")).isin(*_UTC)


@dataclass(frozen=True)
class DateRange:
    """Two days, both included: START:END."""

    start: str
    end: str

    @classmethod
    def parse(cls, text: str) -> DateRange:
        start, colon, end = text.partition(":")
        try:
            days = [date.fromisoformat(x) for x in (start, end)]
        except ValueError as e:
            raise ValueError(f"a range is START:END with two days as YYYY-MM-DD: {text}") from e
        if not colon or days[0] > days[1] or [d.isoformat() for d in days] != [start, end]:
            raise ValueError(f"a range begins before it ends, with days as YYYY-MM-DD: {text}")
        return cls(start, end)

    @property
    def code(self) -> str:
        return f"{self.start.replace('-', '')}-{self.end.replace('-', '')}"

    @property
    def label(self) -> str:
        return f"{self.start}/{self.end}"

    @classmethod
    def of_code(cls, code: str) -> DateRange | None:
        found = re.fullmatch(r"(\d{4})(\d{2})(\d{2})-(\d{4})(\d{2})(\d{2})", code)
        return cls("-".join(found.groups()[:3]), "-".join(found.groups()[3:])) if found else None


def period_label(code: Column) -> Column:
    """A period's code, or the two days of a range's."""
    return F.when(code.rlike("^[0-9]{8}-[0-9]{8}$"), F.regexp_replace(code, "^(....)(..)(..)-(....)(..)(..)$", "$1-$2-$3/$4-$5-$6")).otherwise(code)


def check_reference(text: str) -> str:
    """Type/id, or an error."""
    if not re.fullmatch(r"[A-Z][A-Za-z0-9]*/[A-Za-z0-9.\-]{1,64}", text):
        raise ValueError(f"not a reference Type/id: {text}")
    return text


def age_text(seconds: int) -> str:
    hours = int(seconds) // 3600
    return f"{hours // 24} days" if hours >= 48 else f"{hours} hours"


def size_text(n: int) -> str:
    """Bytes in the largest unit that leaves at least one, with one decimal."""
    for unit in ("B", "KB", "MB", "GB", "TB"):
        if n < 1024 or unit == "TB":
            return f"{n} B" if unit == "B" else f"{n:.1f} {unit}"
        n /= 1024
    raise AssertionError


def thousands(n: int) -> str:
    return f"{n:,}"


def clock(seconds: float) -> str:
    return f"{int(seconds) // 3600}:{int(seconds) // 60 % 60:02}:{int(seconds) % 60:02}"
