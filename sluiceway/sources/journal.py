"""Moving finished files into a directory of data, all or nothing.

What is to move is written below `<path>/_staged/<name>` first. Then a journal, which is there as a whole or not at all, says
what replaces what; from then on the change counts, and is carried out: by the one who wrote it, or by the next writer
if that one died on the way. Each move is made once, as its source is gone afterwards.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

from sluiceway.sources import storage

STAGED = "_staged"
JOURNAL = "journal.json"
DATA = "data"


@dataclass(frozen=True)
class Journal:
    """`replaced` are directories that take the place of those of the same name, `removed` those that go, `added` files
    that come beside others. `tag` names the change, so that it is made once: `<job>#<number>`."""

    name: str
    replaced: Sequence[str] = field(default=())
    removed: Sequence[str] = field(default=())
    added: Sequence[str] = field(default=())
    tag: str | None = None


def staging(path: str, name: str) -> str:
    """Where the data of a change is written."""
    return f"{path}/{STAGED}/{name}/{DATA}"


def pending(spark: SparkSession, path: str) -> list[Journal]:
    """Changes that count but may not be carried out in full."""
    names = [n for n in storage.children(spark, f"{path}/{STAGED}") if not n.startswith("done-")]
    found = [f"{path}/{STAGED}/{name}/{JOURNAL}" for name in names]
    return [Journal(**json.loads(storage.read_text(spark, file))) for file in found if storage.exists(spark, file)]


def commit(spark: SparkSession, path: str, journal: Journal) -> None:
    """From here on the change counts."""
    storage.publish_text(spark, f"{path}/{STAGED}/{journal.name}/{JOURNAL}", json.dumps(asdict(journal)))


def carry_out(spark: SparkSession, path: str, journal: Journal) -> None:
    data = staging(path, journal.name)
    for name in journal.removed:
        storage.delete(spark, f"{path}/{name}")
    for name in [*journal.replaced, *journal.added]:
        if not storage.exists(spark, f"{data}/{name}"):
            continue
        if name in journal.replaced:
            storage.delete(spark, f"{path}/{name}")
        parent = f"{path}/{name}".rpartition("/")[0]
        if not storage.exists(spark, parent):
            storage.make_directory(spark, parent)
        storage.rename(spark, f"{data}/{name}", f"{path}/{name}")
    if journal.tag is not None:
        _mark_done(spark, path, journal.tag)
    storage.delete(spark, f"{path}/{STAGED}/{journal.name}")


def recover(spark: SparkSession, path: str) -> None:
    """Carry out what counts; drop what was given up half-way. For writers: there is one per directory."""
    for journal in pending(spark, path):
        carry_out(spark, path, journal)
    for name in storage.children(spark, f"{path}/{STAGED}"):
        if not name.startswith("done-"):
            storage.delete(spark, f"{path}/{STAGED}/{name}")


def _done_file(spark: SparkSession, path: str, job: str) -> str:
    digest = spark._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(job)
    return f"{path}/{STAGED}/done-{digest[:16]}"


def _mark_done(spark: SparkSession, path: str, tag: str) -> None:
    job, _, number = tag.rpartition("#")
    storage.write_text(spark, _done_file(spark, path, job), number)


def is_done(spark: SparkSession, path: str, tag: str) -> bool:
    """Whether the change of this tag, or a later one of its job, was carried out."""
    job, _, number = tag.rpartition("#")
    file = _done_file(spark, path, job)
    return storage.exists(spark, file) and int(storage.read_text(spark, file) or -1) >= int(number)
