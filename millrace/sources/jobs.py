"""Jobs: run a function of a session in the background and keep its state as a table.

With a folder (any store that Spark writes to) each job's state is a JSON file there, written
anew at each change, so that another session finds it; one session owns a job.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "job_id string, status string, created_at double, completed_at double, progress double, phase string, result string, error string"


class Jobs:
    """Submits functions to a pool of its own; a job is running, then success, failure or timeout.

    Jobs that an earlier session left running are failures here.
    """

    def __init__(self, spark: SparkSession, workers: int = 4, folder: str | None = None):
        self.spark, self.pool, self.folder = spark, ThreadPoolExecutor(workers), folder and folder.rstrip("/")
        self.rows: dict[str, dict] = {}
        self.futures: dict[str, Future] = {}
        if self.folder and self._files().exists(self._path("")):
            for r in spark.read.schema(SCHEMA).json(self.folder).collect():  # one row for each job kept
                self.rows[r["job_id"]] = r.asDict()
                if r["status"] == "running":
                    self.rows[r["job_id"]].update(status="failure", error="its session ended", completed_at=time.time())
                    self._save(r["job_id"])

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _save(self, job: str) -> None:
        if self.folder and job in self.rows:
            out = self._files().create(self._path(f"{job}.json"), True)
            out.write(bytearray(json.dumps(self.rows[job]).encode()))
            out.close()

    def submit(self, work: Callable[[Callable[[str, float, dict], None]], str]) -> str:
        """``work`` gets a function that notes its progress, and returns the place of its result."""
        job = uuid.uuid4().hex
        row = self.rows[job] = {"job_id": job, "status": "running", "created_at": time.time(), "completed_at": None, "progress": 0.0, "phase": None, "result": None, "error": None}

        def note(phase: str, share: float, _: dict) -> None:
            row.update(phase=phase, progress=float(share))
            self._save(job)

        def run() -> None:
            try:
                row.update(result=str(work(note)), status="success", progress=1.0)
            except Exception as e:
                row.update(error=str(e), status="failure")
            finally:
                row["completed_at"] = time.time()
                self._save(job)

        self._save(job)
        self.futures[job] = self.pool.submit(run)
        return job

    def wait(self, job: str, timeout: float | None = None) -> dict:
        """The state when the job is done, or after ``timeout`` seconds, when it is marked so (and may still end)."""
        try:
            self.futures[job].result(timeout)
        except TimeoutError:
            self.rows[job]["status"] = "timeout"
            self._save(job)
        return self.status(job)

    def expire(self, seconds: float) -> int:
        """Delete jobs that ended more than ``seconds`` ago; returns how many."""
        old = [j for j, r in self.rows.items() if r["completed_at"] is not None and r["completed_at"] < time.time() - seconds]
        return sum(self.delete(j) for j in old)

    def status(self, job: str) -> dict:
        return dict(self.rows[job])

    def delete(self, job: str) -> bool:
        self.futures.pop(job, None)
        if self.folder and job in self.rows:
            self._files().delete(self._path(f"{job}.json"), False)
        return self.rows.pop(job, None) is not None

    def table(self) -> DataFrame:
        return self.spark.createDataFrame([tuple(r.values()) for r in self.rows.values()], SCHEMA)
