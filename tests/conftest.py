from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from plaza import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def put():
    """Write one snapshot file: put(root, community, date, name, content)."""

    def write(root, community, date, name, content):
        folder = Path(root) / "reddit" / community / f"date={date}"
        folder.mkdir(parents=True, exist_ok=True)
        text = content if isinstance(content, str) else json.dumps(content, indent=2)
        (folder / name).write_text(text, encoding="utf-8")

    return write


def post(identifier, **fields):
    return {
        "id": identifier, "subreddit": "tools", "title": f"title {identifier}", "score": 10,
        "num_comments": 2, "created_utc": 1711800000.0, "author": "ann", "flair": "Talk", **fields,
    }


def comment(identifier, **fields):
    return {
        "id": identifier, "post_id": "p1", "author": "bob", "body": f"body {identifier}", "score": 3,
        "depth": 0, "created_utc": 1711803600.0, **fields,
    }


def rows(df, *columns):
    """The rows as sorted tuples."""
    found = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda row: tuple((value is not None, str(value)) for value in row))


def plan(df):
    return df._jdf.queryExecution().toString()
