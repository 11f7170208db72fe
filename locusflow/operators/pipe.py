"""Streaming partitions through a command that the user brings."""

from __future__ import annotations

import shlex
import subprocess
import threading
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

#: Output lines per Arrow batch.
BATCH_LINES = 10_000


def build_command(
    tool: str, base: Mapping[str, Sequence[str]], extra: Mapping[str, str] | None = None
) -> list[str]:
    """Command of ``tool`` with the user's additional arguments; unknown tool names are rejected."""
    unknown = set(extra or {}) - set(base)
    if tool not in base or unknown:
        raise ValueError(f"unknown tool: {', '.join(sorted(unknown)) or tool}")
    return [*base[tool], *shlex.split((extra or {}).get(tool, ""))]


def pipe_partitions(df: DataFrame, command: Sequence[str], column: str = "value") -> DataFrame:
    """Each partition's lines through ``command``; its output lines come back as ``value``.

    Rows travel in Arrow batches and the process runs concurrently with its input,
    so a partition is never held in memory.  A non-zero exit fails the task, which
    Spark then retries.  Every executor needs the command.
    """
    argv = list(command)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process = subprocess.Popen(argv, stdin=subprocess.PIPE, stdout=subprocess.PIPE)
        failure: list[BaseException] = []

        def feed() -> None:
            try:
                for batch in batches:
                    lines = batch.column(0).to_pylist()
                    if lines:
                        process.stdin.write(("\n".join(line or "" for line in lines) + "\n").encode())
            except BrokenPipeError:
                pass  # The exit code tells whether the command stopped early on purpose.
            except BaseException as error:  # noqa: BLE001 - handed to the task thread
                failure.append(error)
            finally:
                try:
                    process.stdin.close()
                except BrokenPipeError:
                    pass

        writer = threading.Thread(target=feed, daemon=True)
        writer.start()
        held: list[str] = []
        for line in process.stdout:
            held.append(line.removesuffix(b"\n").decode())  # only a line feed ends a line
            if len(held) >= BATCH_LINES:
                yield pa.RecordBatch.from_pydict({"value": pa.array(held, pa.string())})
                held = []
        writer.join()
        code = process.wait()
        if failure:
            raise failure[0]
        if code != 0:
            raise RuntimeError(f"{argv[0]} exited with {code}")
        if held:
            yield pa.RecordBatch.from_pydict({"value": pa.array(held, pa.string())})

    return df.select(column).mapInArrow(run, "value string")
