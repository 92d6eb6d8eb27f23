"""Import jobs of a hosted store, by a client that the caller gives: ``client(method, url, headers, body) -> dict``."""

from __future__ import annotations

import time
from collections.abc import Callable

from ..options import Options
from ..storage import for_import

Client = Callable[[str, str, dict, dict | None], dict]


class ImportFailed(RuntimeError):
    """The store refused the job, or the job failed."""


def _call(client: Client, method: str, url: str, options: Options, body: dict | None = None) -> dict:
    answer = client(method, url, {"Authorization": f"Bearer {options['cloud.apiKey']}", "Content-Type": "application/json"}, body)
    if answer.get("code") != 200:
        raise ImportFailed(f"{url}: {answer.get('code')} {answer.get('message', '')}")
    return answer.get("data") or {}


def start(client: Client, endpoint: str, options: Options, object_url: str, access_key: str, secret_key: str) -> str:
    """The id of a new job that imports the files below ``object_url`` into the collection that ``options`` name."""
    body = {
        "clusterId": options["cloud.instanceID"], "collectionName": options["collection.name"], "partitionName": options["partition.name"],
        "objectUrl": for_import(object_url), "accessKey": access_key, "secretKey": secret_key,
    }
    return str(_call(client, "POST", f"{endpoint.rstrip('/')}/import", options, body)["jobId"])


def wait(client: Client, endpoint: str, options: Options, job: str, poll_s: float = 3.0, timeout_s: float = 3600.0, sleep: Callable[[float], None] = time.sleep) -> dict:
    """The job's last report. ImportFailed where it reports an error; TimeoutError where it takes too long."""
    waited = 0.0
    while True:
        report = _call(client, "GET", f"{endpoint.rstrip('/')}/import?jobId={job}&clusterId={options['cloud.instanceID']}", options)
        if report.get("errorMessage") not in (None, "", "null"):
            raise ImportFailed(f"job {job}: {report['errorMessage']}")
        if float(report.get("readyPercentage", 0)) >= 1:
            return report
        if waited >= timeout_s:
            raise TimeoutError(f"job {job} isn't done after {timeout_s:g} s")
        sleep(poll_s)
        waited += poll_s
