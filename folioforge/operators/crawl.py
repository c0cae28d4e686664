"""A journal's crawl: from its home page to the table of its articles, a level at a time, over pages that the data source fetches.

Each level looks for its links in the pages of the level before. Pages that an earlier level has fetched aren't fetched
again. A level's pages and links are tables in the crawl's folder, each committed as a whole; a crawl that was stopped goes on
behind the last one that was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import documents as P
from folioforge.operators.relational import union, unseen
from folioforge.sources import mirror

LINKS = "base string, seq int, href string, url string, path string, filename string, mirror_path string, string string, level string"


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def once(df_of, spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at path; written first, from df_of(), unless it was to its end."""
    if not committed(spark, path):
        df_of().write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


class Crawl:
    """One journal's crawl in a folder. options: those of the data source `pages`; lanes: of its tasks."""

    def __init__(self, spark: SparkSession, journal: str, home: str, folder: str, lanes: int = 64, **options):
        self.spark, self.journal, self.home, self.folder, self.lanes, self.options = spark, journal, home, folder.rstrip("/"), lanes, options
        self.levels, self.pages = [*P.HARVEST[journal]], []
        mirror.register(spark)

    def fetched(self, step: int, wanted: DataFrame) -> DataFrame:
        """Pages (url, mirror_path, content, length, attempts) of those links that no earlier step has fetched."""
        at = f"{self.folder}/step={step}"

        def scan() -> DataFrame:
            todo = wanted.groupBy("url").agg(F.min("mirror_path").alias("mirror_path"))
            todo = unseen(todo, union(*(p.select("url") for p in self.pages)), "url") if self.pages else todo
            if not committed(self.spark, f"{at}/links"):
                mirror.queue(todo, f"{at}/links", self.lanes, mode="overwrite")
            return self.spark.read.format("pages").options(links=f"{at}/links", **self.options).load()

        out = once(scan, self.spark, f"{at}/pages", mirror.SCHEMA)
        self.pages.append(out)
        return out

    def looked_in(self, level: str, links: DataFrame) -> tuple[DataFrame, str | None]:
        """The links to the pages in which a level's links are looked for, and what these are resolved against if not the pages."""
        if self.journal == "eid" and level == "volume":
            base = links.agg(F.min("url")).first()[0]
            stem = (base or "").rsplit("/past-issues/", 1)[0]
            rows = [(stem + end, f"{mirror_root(stem)}{end}.html") for end in P.EID_VOLUMES] if base else []
            return self.spark.createDataFrame(rows, "url string, mirror_path string"), base
        if self.journal == "pcd" and level == "series":
            root = "/".join(self.home.split("/")[:3])
            spanish = self.spark.createDataFrame([(f"{root}/{P.PCD_SPANISH}", f"/{P.PCD_SPANISH}")], "url string, mirror_path string")
            return links.select("url", "mirror_path").unionByName(spanish), None
        return links.select("url", "mirror_path"), None

    def run(self, levels: int | None = None) -> DataFrame:
        """Link rows of all levels (D1-D8) with the length of the page that each leads to: null for those of another level
        than the last whose page no level looked in, 0 for pages that never answered. levels: stop behind so many."""
        home = self.spark.createDataFrame([(self.home, mirror_root(self.home, True))], "url string, mirror_path string")
        links, found = home, []
        for step, level in enumerate(self.levels[:levels]):
            wanted, base = self.looked_in(level, links)
            self.fetched(step, wanted)
            known = union(*self.pages)
            looked = wanted.select("url").distinct()

            def rows(level=level, base=base, known=known, looked=looked) -> DataFrame:
                html = mirror.fetched_pages(known.join(looked, "url", "left_semi")).where("html <> ''")
                return P.harvest(self.journal, {level: html}, base)

            links = once(rows, self.spark, f"{self.folder}/step={step}/found", LINKS)
            found.append(links)
        if levels is None:
            self.fetched(len(self.levels), links.select("url", "mirror_path"))
        lengths = union(*(p.select("url", "length") for p in self.pages))
        return union(*found).join(lengths, "url", "left")


def mirror_root(url: str, kept: bool = False) -> str:
    """The path of a URL; kept: that of its file in a mirror."""
    path = "/" + "/".join(url.split("/")[3:])
    if not kept:
        return path.rstrip("/")
    name = path.rsplit("/", 1)[1]
    return path + "index.html" if not name else path if "." in name.strip(".") else path + ".html"
