"""Canonical JSON, its digest, and signed envelopes. Signatures need the `cryptography` package."""

from __future__ import annotations

import base64
import hashlib
import json
import os

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

try:
    from cryptography.hazmat.primitives import serialization
    from cryptography.hazmat.primitives.asymmetric.ed25519 import Ed25519PrivateKey
except ImportError:  # signing is refused then
    serialization = Ed25519PrivateKey = None


def canonical(payload) -> bytes:
    """Sorted keys, no blanks, ASCII. What JSON can't hold is a TypeError."""
    return json.dumps(payload, sort_keys=True, separators=(",", ":"), ensure_ascii=True).encode()


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def canonical_json(text: Column) -> Column:
    """Any JSON text in canonical form; null for what is no JSON."""

    def one(s: str | None) -> str | None:
        try:
            return None if s is None else canonical(json.loads(s)).decode()
        except ValueError:
            return None

    @F.pandas_udf("string")
    def made(xs: pd.Series) -> pd.Series:
        return xs.map(one)

    return made(text)


def payload_hash(text: Column) -> Column:
    return F.sha2(canonical_json(text), 256)


def unpadded(data: bytes) -> str:
    return base64.urlsafe_b64encode(data).rstrip(b"=").decode()


def envelope(payload, sign, key_id: str, signed_at: str) -> dict:
    """The payload and a signature over its canonical form; sign: bytes to signature."""
    data = canonical(payload)
    return {"payload": payload, "signature": {"algorithm": "ed25519", "key_id": key_id, "signed_at": signed_at, "payload_hash_sha256": digest(data), "signature_b64": unpadded(sign(data))}}


def signer(pem: bytes):
    """sign() of an Ed25519 private key in PEM."""
    if serialization is None:
        raise RuntimeError("signing needs the cryptography package")
    key = serialization.load_pem_private_key(pem, password=None)
    if not isinstance(key, Ed25519PrivateKey):
        raise ValueError("no Ed25519 key")
    return key.sign


def new_keys(folder: str) -> tuple[str, str]:
    """Paths of a new private key (readable by its owner alone) and its public key, both in PEM; an existing key is never replaced."""
    if serialization is None:
        raise RuntimeError("signing needs the cryptography package")
    key = Ed25519PrivateKey.generate()
    private = key.private_bytes(serialization.Encoding.PEM, serialization.PrivateFormat.PKCS8, serialization.NoEncryption())
    public = key.public_key().public_bytes(serialization.Encoding.PEM, serialization.PublicFormat.SubjectPublicKeyInfo)
    paths = os.path.join(folder, "private_key.pem"), os.path.join(folder, "public_key.pem")
    for path, data, mode in zip(paths, (private, public), (0o600, 0o644)):
        with os.fdopen(os.open(path, os.O_WRONLY | os.O_CREAT | os.O_EXCL, mode), "wb") as out:
            out.write(data)
    return paths


def trust_entry(public_pem: str, key_id: str, issuer: str) -> dict:
    return {"key_id": key_id, "issuer": issuer, "algorithm": "ed25519", "public_key_pem": public_pem}
