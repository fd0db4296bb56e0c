"""Derived keys kept between runs, so that a later run derives only values it has not met."""

from __future__ import annotations

import hashlib
import hmac
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskflow.sources.files import exists, list_tables

VERSION = re.compile(r"version-(\d+)-[0-9a-f]+")


@dataclass(frozen=True)
class KeyDictionary:
    """A folder of versions, each a table (digest, derived) with the keys one run has added.

    The digest is that of salt and value under ``digest_key``, a secret that must stay the
    same between runs and is kept as salts are; neither values nor salts are stored. A version
    counts once its write is complete. Runs at the same time may both add a key, with equal
    rows, as a key follows from salt and value: lookups take one of them.
    """

    folder: str
    digest_key: str = field(repr=False)

    def label(self, salt: str) -> str:
        """Stands for a salt in digests."""
        return hmac.new(self.digest_key.encode(), salt.encode(), hashlib.sha256).hexdigest()

    @staticmethod
    def digest(label: Column, value: Column, key: Column) -> Column:
        """Digest of a value under a salt's label; ``key`` is the digest key as a secret."""
        return F.sha2(F.concat(key, F.lit("/"), label, F.lit("/"), value, F.lit("/"), key), 256)

    def _versions(self, spark: SparkSession) -> dict[int, list[str]]:
        if not exists(spark, self.folder):
            return {}
        try:
            found = list_tables(spark, self.folder)
        except ValueError:  # an empty folder
            return {}
        versions: dict[int, list[str]] = {}
        for name, path in found.items():
            match = VERSION.fullmatch(name)
            if match and exists(spark, f"{path}/_SUCCESS"):
                versions.setdefault(int(match[1]), []).append(path)
        return versions

    def keys(self, spark: SparkSession) -> DataFrame:
        """(digest, derived) of all versions, a row for each digest."""
        paths = [path for paths in self._versions(spark).values() for path in paths]
        schema = "digest string, derived string"
        found = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
        return found.groupBy("digest").agg(F.max("derived").alias("derived"))

    def append(self, new: DataFrame) -> None:
        """Add the rows (digest, derived) as the next version; none if there are none."""
        if new.isEmpty():
            return
        number = max(self._versions(new.sparkSession), default=0) + 1
        path = f"{self.folder.rstrip('/')}/version-{number:06d}-{uuid.uuid4().hex}"
        new.select("digest", "derived").write.parquet(path)

    def versions(self, spark: SparkSession) -> DataFrame:
        """(version, n_keys): how many keys each version has added."""
        counts = spark.createDataFrame([], "version int, n_keys bigint")
        for number, paths in sorted(self._versions(spark).items()):
            rows = spark.read.parquet(*paths).agg(F.lit(number).alias("version"), F.count(F.lit(1)).alias("n_keys"))
            counts = counts.unionByName(rows)
        return counts
