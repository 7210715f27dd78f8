"""Files of any file system that Spark reaches, seen from the driver: names and sizes only, never contents of tables."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    fs, at = _at(spark, path)
    fs.delete(at, True)


def put_in_place(spark: SparkSession, made: str, path: str) -> None:
    """Let a finished folder take the place of what is at `path`."""
    fs, at = _at(spark, path)
    fs.mkdirs(at.getParent())
    fs.delete(at, True)
    if not fs.rename(_at(spark, made)[1], at):
        raise OSError(f"cannot move {made} to {path}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not there."""
    fs, at = _at(spark, path)
    fresh = _at(spark, f"{path}.new")[1]
    out = fs.create(fresh, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(at, False)
    fs.rename(fresh, at)


def read_texts(spark: SparkSession, folder: str, ending: str) -> dict[str, str]:
    """The small files of a folder with a given ending."""
    if not exists(spark, folder):
        return {}
    names = [s.getPath().getName() for s in _at(spark, folder)[0].listStatus(_at(spark, folder)[1])]
    found = {}
    for name in sorted(n for n in names if n.endswith(ending)):
        fs, at = _at(spark, f"{folder}/{name}")
        stream = fs.open(at)
        found[name.removesuffix(ending)] = bytes(stream.readAllBytes()).decode()
        stream.close()
    return found


def states(spark: SparkSession, paths: list[str]) -> list[str]:
    """Place, size and time of change of each file, given as `DataFrame.inputFiles` does; folders are listed once."""
    uri, path_of = spark._jvm.java.net.URI, spark._jvm.org.apache.hadoop.fs.Path
    wanted, found = {uri.create(p).getRawPath() for p in paths}, []
    for folder in sorted({p.rpartition("/")[0] for p in paths}):
        at = path_of(uri.create(folder))
        for s in at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at):
            place = s.getPath().toUri().getRawPath()
            if place in wanted:
                found.append(f"{place} {s.getLen()} {s.getModificationTime()}")
    return sorted(found)
