"""Feed the event table to a stream in several files and collect what comes out."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq

HEARTBEAT_USER = -1
HEARTBEAT_DAYS = (200, 400)


def event_files(source: str, folder: str, files: int = 4, disorder_ms: int = 0) -> str:
    """Events cut into files by id, then two files with one late heartbeat row of another key.

    ``disorder_ms`` shuffles rows between files as far as that event-time bound allows.
    """
    table = pq.read_table(f"{source}/events.parquet").to_pandas()
    start, end = table["ts"].min(), table["ts"].max()
    span = (end - start) / files
    place = ((table["ts"] - start) / span).astype(int).clip(upper=files - 1)
    if disorder_ms:
        # a row close to a file's end may come one file late
        into = (table["ts"] - start) % span
        late = (span - into < pd.Timedelta(milliseconds=disorder_ms)) & (table["event_id"] % 2 == 0)
        place = (place + late.astype(int)).clip(upper=files - 1)
    for i in range(files):
        part = table[place == i].sample(frac=1.0, random_state=i)
        write(part, f"{folder}/part-{i}.parquet")
    for i, days in enumerate(HEARTBEAT_DAYS):
        beat = pd.DataFrame(
            {
                "event_id": [10**9 + i], "ts": [end + pd.Timedelta(days=days)], "user_id": [HEARTBEAT_USER],
                "event_type": ["beat"], "value": [0.0], "props": ["{}"],
            }
        )
        write(beat, f"{folder}/part-{files + i}.parquet")
    return folder


def write(rows: pd.DataFrame, path: str) -> None:
    fields = pa.schema(
        [("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()), ("event_type", pa.string()),
         ("value", pa.float64()), ("props", pa.string())]
    )
    rows = rows.assign(ts=rows["ts"].astype("datetime64[us]"))
    pq.write_table(pa.Table.from_pandas(rows, schema=fields, preserve_index=False), path)


def drain(df, name: str, folder: str, mode: str = "append"):
    """Run the stream until its input is used up and return the memory sink as a table."""
    query = (
        df.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", f"{folder}/checkpoint-{name}").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return df.sparkSession.table(name)


def values(df, *columns: str) -> list[tuple]:
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)
