"""URL filters: rules in memory-mapped arrays sorted by 64-bit digest."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskflow.llm.common import stored
from maskflow.llm.warc import open_store
from maskflow.sources.shared import new_path

ALLOW, BLOCK = "allow", "block"
# Bytes of keys, strings and values of one array file, built by one task.
PART_BYTES = 64 << 20
BITS = 64
SEED = 42


# -- urls

def host_of(url: str | Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case;
    empty without it."""
    host = F.regexp_extract(_behind_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str | Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_behind_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _behind_scheme(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


# -- arrays

def encode_array(keys: np.ndarray, strings: list[bytes], values: list[np.ndarray]) -> bytes:
    """An array file: the number of entries, then for all entries in the order of their keys
    the keys, the ends of strings and of values, the values, and the strings."""
    order = np.argsort(keys, kind="stable")
    strings = [strings[k] for k in order]
    values = [np.asarray(values[k], dtype=np.int32) for k in order]
    string_ends = np.cumsum([0, *map(len, strings)], dtype=np.int64)
    value_ends = np.cumsum([0, *map(len, values)], dtype=np.int64)
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    head = np.array([len(keys)], dtype=np.int64)
    return b"".join(
        (head.tobytes(), keys[order].tobytes(), string_ends.tobytes(), value_ends.tobytes(),
         flat.astype(np.int32).tobytes(), b"".join(strings))
    )


class DigestArray:
    """Entries sorted by digest, read from a buffer that is mapped into memory: strings with
    some numbers each."""

    def __init__(self, buffer):
        size = int(np.frombuffer(buffer, np.int64, 1)[0])
        at = 8
        self.keys = np.frombuffer(buffer, np.uint64, size, at)
        at += 8 * size
        self.string_ends = np.frombuffer(buffer, np.int64, size + 1, at)
        at += 8 * (size + 1)
        self.value_ends = np.frombuffer(buffer, np.int64, size + 1, at)
        at += 8 * (size + 1)
        self.values = np.frombuffer(buffer, np.int32, int(self.value_ends[-1]), at)
        self.strings = np.frombuffer(buffer, np.uint8, -1, at + 4 * int(self.value_ends[-1])) if size else None

    def find(self, keys: np.ndarray, strings: list[bytes]) -> np.ndarray:
        """Number of the entry with each string, or -1.

        Keys are searched all at once. Entries may share a key, and a key may be that of
        another string: stored strings are compared in full.
        """
        low = np.searchsorted(self.keys, keys, side="left")
        high = np.searchsorted(self.keys, keys, side="right")
        found = np.full(len(keys), -1, dtype=np.int64)
        for k in np.flatnonzero(low < high):
            for entry in range(low[k], high[k]):
                start, end = self.string_ends[entry : entry + 2]
                if self.strings[start:end].tobytes() == strings[k]:
                    found[k] = entry
                    break
        return found

    def values_of(self, entry: int) -> np.ndarray:
        return self.values[self.value_ends[entry] : self.value_ends[entry + 1]]


def mapped(uri: str) -> DigestArray:
    """An array file mapped into memory, once for every Python worker.

    A file of a local path is mapped where it is. One that only the store reads is copied
    to a temporary file first, which has no name any more and goes with the worker.
    """
    held = sys.modules.setdefault("_maskflow_arrays", type(sys)("_maskflow_arrays")).__dict__
    if uri not in held:
        store, name = open_store(uri)
        if isinstance(store, fs.LocalFileSystem):
            buffer = pa.memory_map(name).read_buffer()
        else:
            with tempfile.TemporaryFile() as copy, store.open_input_stream(name) as file:
                while chunk := file.read(1 << 20):
                    copy.write(chunk)
                copy.flush()
                buffer = np.memmap(copy, dtype=np.uint8, mode="r")
        held[uri] = DigestArray(buffer)
    return held[uri]


class Lookup:
    """Arrays of one kind, cut by the upper bits of their keys; opened when probed."""

    def __init__(self, files: dict[int, str], part_bits: int, bits: int):
        self.files, self.part_bits, self.bits = files, part_bits, bits

    def find(self, strings: list[str]) -> list[np.ndarray | None]:
        """Values of the entries with these strings; None where there is none."""
        found: list[np.ndarray | None] = [None] * len(strings)
        if not strings or not self.files:
            return found
        data = [text.encode("utf-8", "surrogatepass") for text in strings]
        keys = np.array([xxhash.xxh64_intdigest(d, SEED) for d in data], dtype=np.uint64)
        parts = keys >> np.uint64(64 - self.part_bits) if self.part_bits else np.zeros(len(keys), np.uint64)
        keys = keys >> np.uint64(64 - self.bits)
        for part in np.unique(parts).tolist():
            if part not in self.files:
                continue
            own = np.flatnonzero(parts == part)
            array = mapped(self.files[part])
            entries = array.find(keys[own], [data[k] for k in own])
            for k, entry in zip(own, entries):
                if entry >= 0:
                    found[k] = array.values_of(entry)
        return found


# -- building

def write_arrays(entries: DataFrame, folder: str, kind: str, bits: int, part_bytes: int) -> tuple[dict[int, str], int]:
    """Write ``entries`` (string, numbers), one row a string, as array files; gives the files by
    part and the number of bits parts are cut by.

    Parts are ranges of the digest, so each is a task of about ``part_bytes``, whatever the
    strings are. Only files of attempts that succeed are named; the driver holds a name for
    every ``part_bytes`` of rules.
    """
    size = entries.agg(F.sum(F.octet_length("string") + 4 * F.size("numbers") + 24)).first()[0] or 0
    part_bits = max(0, int(np.ceil(np.log2(max(1, size / part_bytes)))))
    part_bits = min(part_bits, bits)
    key = F.xxhash64("string")
    part = F.shiftrightunsigned(key, 64 - part_bits) if part_bits else F.lit(0).cast("bigint")

    def write(group: pd.DataFrame) -> pd.DataFrame:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        number = int(group["part"].iloc[0])
        name = f"{kind}-{number}-{uuid.uuid4().hex}"
        keys = group["key"].to_numpy(np.int64).view(np.uint64) >> np.uint64(64 - bits)
        strings = [text.encode("utf-8", "surrogatepass") for text in group["string"]]
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            out.write(encode_array(keys, strings, list(group["numbers"])))
        return pd.DataFrame({"part": [number], "path": [f"{folder}/{name}"]})

    rows = entries.select("string", "numbers", key.alias("key"), part.alias("part"))
    written = rows.groupBy("part").applyInPandas(write, "part bigint, path string")
    return {row["part"]: row["path"] for row in stored(written, kind).collect()}, part_bits


class UrlFilter:
    """Rules (host, path, verdict) for a host with all its subdomains and for the paths that
    begin with a path.

    ``hosts`` gives, for every host of a rule, the lengths of its rules' paths, so that a
    url is probed for these beginnings of its path alone; ``rules`` gives the verdicts.
    """

    def __init__(self, hosts: Lookup, rules: Lookup, labels: int, default: str):
        self.hosts, self.rules, self.labels, self.default = hosts, rules, labels, default

    @classmethod
    def build(cls, rules: DataFrame, folder: str | None = None, default: str = ALLOW,
              bits: int = BITS, part_bytes: int = PART_BYTES) -> UrlFilter:
        """Write the arrays of ``rules`` to the shared folder, or to ``folder``.

        Hosts are put in lower case (A-Z). Null hosts and paths count as empty; of rules of
        one host and path ``block`` holds; other verdicts than allow and block raise.
        ``default`` is the verdict on urls that no rule fits.
        """
        folder = (folder or new_path(rules.sparkSession, "url-filter")).rstrip("/")
        host = F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        known = F.when(F.col("verdict").isin(ALLOW, BLOCK), F.col("verdict") == BLOCK)
        known = F.coalesce(known, F.raise_error(F.lit("verdicts are allow and block")).cast("boolean"))
        single = stored(
            rules.select(
                F.coalesce(host, F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                known.alias("block"),
            ).groupBy("host", "path").agg(F.max("block").alias("block")),
            "rules",
        )
        lengths = F.sort_array(F.collect_set(F.length("path")), asc=False)
        hosts = single.groupBy(F.col("host").alias("string")).agg(lengths.alias("numbers"))
        whole = F.concat(F.length("host").cast("string"), F.lit(":"), "host", "path")
        verdicts = single.select(whole.alias("string"), F.array(F.col("block").cast("int")).alias("numbers"))
        found = [
            Lookup(*write_arrays(entries, folder, kind, bits, part_bytes), bits)
            for entries, kind in ((hosts, "hosts"), (verdicts, "paths"))
        ]
        labels = single.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
        return cls(*found, labels, default)

    def suffixes(self, host: str) -> list[str]:
        """The host and what follows its dots, longest first, of as many labels as rules have."""
        labels = host.rsplit(".", self.labels) if self.labels else []
        # With more labels than any rule the first piece is no label of its own.
        first = 1 if len(labels) > self.labels else 0
        return [".".join(labels[k:]) for k in range(first, len(labels))]

    def judge(self, hosts: list[str], paths: list[str]) -> list[tuple[str | None, str]]:
        """(rule, verdict) of every url: that of the longest rule that fits, by the length of
        host and path together and then of the host."""
        distinct = list(dict.fromkeys(hosts))
        wanted = [(host, suffix) for host in distinct for suffix in self.suffixes(host)]
        lengths: dict[str, list[tuple[str, np.ndarray]]] = {}
        for (host, suffix), numbers in zip(wanted, self.hosts.find([suffix for _, suffix in wanted])):
            if numbers is not None:
                lengths.setdefault(host, []).append((suffix, numbers))
        probes = [
            (k, suffix, path[:length])
            for k, (host, path) in enumerate(zip(hosts, paths))
            for suffix, numbers in lengths.get(host, ())
            for length in numbers.tolist()
            if length <= len(path)
        ]
        found = self.rules.find([f"{len(suffix)}:{suffix}{path}" for _, suffix, path in probes])
        best: dict[int, tuple] = {}
        for (k, suffix, path), blocks in zip(probes, found):
            if blocks is not None:
                rank = (len(suffix) + len(path), len(suffix))
                if k not in best or rank > best[k][0]:
                    best[k] = (rank, suffix + path, BLOCK if blocks[0] else ALLOW)
        return [best[k][1:] if k in best else (None, self.default) for k in range(len(hosts))]


def judged(pages: DataFrame, url_filter: UrlFilter, url: str = "url") -> DataFrame:
    """``pages`` with the columns host, path, rule and verdict; the rule is null and the verdict
    the filter's default where none fits.

    One pass, no shuffle; rules are not broadcast but mapped into memory where a task first
    probes them. A null url, and one without ``://``, has an empty host and path; columns of
    these names that the table has are replaced; an empty table stays empty.
    """

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for hosts, paths in batches:
            yield pd.DataFrame(url_filter.judge(list(hosts), list(paths)), columns=["rule", "verdict"])

    parts = pages.withColumns({"host": host_of(url), "path": path_of(url)})
    found = F.pandas_udf(run, "rule string, verdict string")(F.col("host"), F.col("path"))
    name = "_judged"
    while name in pages.columns:
        name += "_"
    rows = parts.withColumn(name, found)
    rows = rows.withColumns({"rule": F.col(f"{name}.rule"), "verdict": F.col(f"{name}.verdict")})
    return rows.drop(name)


def allowed(pages: DataFrame, url_filter: UrlFilter, url: str = "url") -> DataFrame:
    """The pages whose url is allowed, with their columns alone."""
    return judged(pages.select(F.struct("*").alias("page"), F.col(url).alias("url")), url_filter).where(
        F.col("verdict") == ALLOW
    ).select("page.*")
