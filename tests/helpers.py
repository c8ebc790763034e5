"""Values the tests share."""

from datetime import datetime, timezone

DATA = "/root/testdata"


def seconds(text: str) -> int:
    """Unix seconds of a UTC time such as ``2024-01-05 10:00:00``."""
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp())
