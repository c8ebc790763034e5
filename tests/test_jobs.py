from datetime import date

import pytest

from adlake.jobs import parse
from adlake.session import CHECKPOINT_DIR, scratch_path

TODAY = date(2024, 3, 10)
SILVER = ["silver", "--lake", "x", "--raw-base", "r"]
GOLD = ["gold", "--lake", "x"]


def test_default_is_yesterday():
    args = parse(SILVER, TODAY)
    assert args.run_date_start == args.run_date_end == date(2024, 3, 9)
    assert (args.click_window_days, args.conversion_window_days) == (7, 30)
    args = parse(GOLD, TODAY)
    assert (args.run_date_start, args.run_date_end) == (None, date(2024, 3, 9))


@pytest.mark.parametrize("job", [SILVER, GOLD])
def test_start_after_end_is_an_error(job):
    with pytest.raises(SystemExit):
        parse([*job, "--run-date-start", "2024-03-09", "--run-date-end", "2024-03-08"], TODAY)


def test_gold_refresh_needs_a_range():
    with pytest.raises(SystemExit):
        parse([*GOLD, "--full-refresh"], TODAY)
    assert parse([*GOLD, "--full-refresh", "--run-date-start", "2024-01-01"], TODAY).full_refresh


def test_stream_arguments():
    args = parse(["bronze", "--raw-base", "r", "--checkpoint-base", "c"], TODAY)
    assert (args.topic_click, args.topic_type, args.starting_offsets) == ("ad-clicks", None, "latest")


class Session:
    """Just the parts of a session that name the scratch folder."""

    def __init__(self, master, **conf):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": lambda _, key, default: conf.get(key, default)})()


def test_scratch_follows_the_session_setting():
    shared = Session("yarn", **{CHECKPOINT_DIR: "s3a://bucket/scratch/"})
    assert scratch_path(shared, "x").startswith("s3a://bucket/scratch/adlake/x-")
    assert scratch_path(shared, "x") != scratch_path(shared, "x")
    with pytest.raises(RuntimeError, match=CHECKPOINT_DIR):
        scratch_path(Session("yarn"), "x")
    assert scratch_path(Session("local[8]"), "x").startswith("/")


def test_daily_takes_a_range_and_reports_a_name():
    daily = ["daily", "--lake", "x", "--raw-base", "r"]
    assert parse(daily, TODAY).run_date_start == date(2024, 3, 9)
    args = parse([*daily, "--run-date-start", "2024-03-01"], TODAY)
    assert (args.run_date_start, args.run_date_end) == (date(2024, 3, 1), date(2024, 3, 9))
    assert parse(["report", "volume", "--lake", "x"], TODAY).as_of == TODAY
    with pytest.raises(SystemExit):
        parse(["report", "nonsense", "--lake", "x"], TODAY)
