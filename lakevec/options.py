"""Options of the collection store and of object storage: names in any case, defaults, validation."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import SparkSession

DEFAULTS = {
    "uri": "", "token": "", "host": "localhost", "port": "19530", "username": "root", "password": "",
    "secure": "false", "secure.servername": "localhost", "secure.serverpempath": "", "secure.cacert": "", "secure.clientcert": "", "secure.clientkey": "",
    "fs": "s3a://", "bucket": "a-bucket", "rootpath": "files",
    "storage.endpoint": "localhost:9000", "storage.user": "", "storage.password": "", "storage.usessl": "false",
    "database.name": "default", "collection.name": "", "partition.name": "",
    "collection.primarykeyfield": "", "collection.vectorfield": "", "collection.vectordim": "32", "collection.autoid": "false",
    "insertmaxbatchsize": "200", "cloud.region": "", "cloud.instanceid": "", "cloud.apikey": "",
}
_CLOUD = re.compile(r"https?://(?P<instance>[^.]+)(?:\.[^.]+)?\.(?P<region>[a-z]+-[a-z0-9-]+)\.")


class Options(Mapping):
    """A case-insensitive mapping with defaults; values are text, with ``flag`` and ``number`` to read them."""

    def __init__(self, given: Mapping[str, object] | None = None):
        self._given = {k.lower(): str(v) for k, v in (given or {}).items()}
        if self.flag("secure") and not self["secure.serverpempath"] and not all(self[f"secure.{k}"] for k in ("cacert", "clientcert", "clientkey")):
            raise ValueError("secure needs secure.serverPemPath, or secure.caCert, secure.clientCert and secure.clientKey")

    def __getitem__(self, key: str) -> str:
        key = key.lower()
        if key in self._given:
            return self._given[key]
        if key in ("cloud.region", "cloud.instanceid") and (m := _CLOUD.match(self._given.get("uri", ""))):
            return m["region"] if key.endswith("region") else m["instance"]
        return DEFAULTS[key]

    def __iter__(self):
        return iter({**DEFAULTS, **self._given})

    def __len__(self) -> int:
        return len({**DEFAULTS, **self._given})

    def flag(self, key: str) -> bool:
        return self[key].strip().lower() == "true"

    def number(self, key: str) -> int:
        return int(self[key])

    @property
    def database(self) -> str:
        """A cloud store has no named databases."""
        return "" if "database.name" not in self._given and self["cloud.apikey"] else self["database.name"]

    def connection(self) -> dict[str, str]:
        """What a client needs: uri and token, or host, port and user; TLS files where ``secure`` is set."""
        base = {"uri": self["uri"], "token": self["token"]} if self["uri"] else {k: self[k] for k in ("host", "port", "username", "password")}
        if self.flag("secure"):
            base |= {k: self[f"secure.{k}"] for k in ("servername", "serverpempath", "cacert", "clientcert", "clientkey") if self[f"secure.{k}"]}
        return base | {"database": self.database}

    def base_path(self) -> str:
        return f"{self['fs']}{self['bucket']}/{self['rootpath']}".rstrip("/")


def configure_storage(spark: SparkSession, options: Options) -> None:
    """Point the s3a file system at the endpoint and keys of ``options``."""
    conf = {
        "fs.s3a.endpoint": options["storage.endpoint"],
        "fs.s3a.access.key": options["storage.user"],
        "fs.s3a.secret.key": options["storage.password"],
        "fs.s3a.connection.ssl.enabled": options["storage.usessl"],
        "fs.s3a.path.style.access": "true",
    }
    for k, v in conf.items():
        spark.sparkContext._jsc.hadoopConfiguration().set(k, v)
