"""Tables of parts that are replaced as one: rows go to new folders, then a manifest names the folders in force.

``path/_manifest`` holds numbered JSON files ``{part: folder}``; the highest number is in force. A manifest comes
into being by a rename that fails if its number is taken, so of two writers that started from the same state the later one
gets ``Conflict`` and nothing is lost. A job that fails before its manifest leaves the table as it was.
"""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Another writer has replaced parts of the table since its state was read."""


class Parts:
    """A table in a folder. Every call looks at the folder anew."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, *names: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))

    def _files(self):
        return self._at().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def state(self) -> tuple[int, dict[str, str]]:
        """The number in force (0 for a new table) and the folder of each part."""
        files = self._files()
        if not files.exists(self._at("_manifest")):
            return 0, {}
        names = [status.getPath().getName() for status in files.listStatus(self._at("_manifest"))]
        numbers = [int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith(".")]
        if not numbers:
            return 0, {}
        text = self.spark.read.text(f"{self.path}/_manifest/{max(numbers):012d}.json", wholetext=True).first()[0]
        return max(numbers), json.loads(text)

    def read(self, schema=None, without: set[str] = frozenset(), only: set[str] | None = None) -> DataFrame | None:
        """The rows of the parts in force, or None if there are none."""
        _, parts = self.state()
        folders = [f"{self.path}/{folder}" for part, folder in sorted(parts.items()) if part not in without and (only is None or part in only)]
        if not folders:
            return None
        return self.spark.read.schema(schema or self.spark.read.parquet(folders[0]).schema).parquet(*folders)

    def new_folder(self) -> str:
        return f"data-{uuid.uuid4().hex}"

    def commit(self, number: int, parts: dict[str, str]) -> None:
        """Put ``parts`` in force as the state after ``number``."""
        jvm = self.spark.sparkContext._jvm
        files, draft = self._files(), self._at("_manifest", f".draft-{uuid.uuid4().hex}")
        stream = files.create(draft, False)
        stream.write(json.dumps(parts, sort_keys=True).encode())
        stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(draft, self._at("_manifest", f"{number + 1:012d}.json"), options)
        except Exception as error:
            files.delete(draft, False)
            if "FileAlreadyExists" in str(error):
                raise Conflict(f"{self.path}: state {number + 1} is already there") from error
            raise

    def put(self, part: str, rows: DataFrame) -> None:
        """Replace one part by ``rows``."""
        number, parts = self.state()
        folder = self.new_folder()
        rows.write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        self.commit(number, {**parts, part: folder})

    def tidy(self) -> list[str]:
        """Remove the folders that the state in force does not name; for when no earlier reader is at work. Returns their names."""
        _, parts = self.state()
        held = {folder.split("/")[0] for folder in parts.values()}
        files = self._files()
        names = [status.getPath().getName() for status in files.listStatus(self._at())]
        gone = [name for name in names if name.startswith("data-") and name not in held]
        for name in gone:
            files.delete(self._at(name), True)
        return gone
