"""URL and address policies as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# IPv4 ranges that are not public, and beginnings of IPv6 addresses that are not.
CLOSED_IPV4 = (
    ("0.0.0.0", 8), ("10.0.0.0", 8), ("100.64.0.0", 10), ("127.0.0.0", 8), ("169.254.0.0", 16), ("172.16.0.0", 12), ("192.0.0.0", 24),
    ("192.0.2.0", 24), ("192.168.0.0", 16), ("198.18.0.0", 15), ("198.51.100.0", 24), ("203.0.113.0", 24), ("224.0.0.0", 4), ("240.0.0.0", 4),
)
CLOSED_IPV6 = "^(::1?$|f[cd]|fe[89ab]|ff|2001:db8:)"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"


def ipv4_number(address: Column) -> Column:
    parts = F.split(address, r"\.")
    return sum((F.get(parts, i).cast("long") * 256 ** (3 - i) for i in range(1, 4)), F.get(parts, 0).cast("long") * 256**3)


def _public_ipv4(address: Column) -> Column:
    n = ipv4_number(address)
    closed = F.lit(False)
    for base, prefix in CLOSED_IPV4:
        first = sum(int(x) << (24 - 8 * i) for i, x in enumerate(base.split(".")))
        closed = closed | n.between(first, first + 2 ** (32 - prefix) - 1)
    return ~closed


def is_public(address: Column) -> Column:
    """Whether an IPv4 or IPv6 address is public; false for anything else, null included."""
    low = F.lower(address)
    mapped = F.regexp_extract(low, rf"^[0:]*::ffff:({IPV4})$", 1)
    six = low.rlike(r"^[0-9a-f:]*:[0-9a-f:]*$") | (mapped != "")
    return F.coalesce(
        F.when(low.isNull(), F.lit(False)).when(low.rlike(f"^{IPV4}$"), _public_ipv4(low)).when(~six | low.rlike(CLOSED_IPV6), F.lit(False)).when(mapped != "", _public_ipv4(mapped)).otherwise(F.lit(True)),
        F.lit(False),
    )


def all_public(addresses: Column) -> Column:
    return F.coalesce((F.size(addresses) > 0) & F.forall(addresses, is_public), F.lit(False))


def url_error(url: Column, protocols: tuple[str, ...] = ("https",), hosts: tuple[str, ...] = (), ports: tuple[int, ...] = (443,)) -> Column:
    """The first rule that a URL breaks; null if none."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    server = F.regexp_replace(authority, "^.*@", "")
    host = F.lower(F.regexp_replace(server, r":\d*$", ""))
    port = F.coalesce(F.regexp_extract(server, r":(\d+)$", 1).try_cast("int"), F.when(scheme == "https", 443).otherwise(80))
    return (
        F.when(url.isNull() | (scheme == "") | (host == ""), "URL_INVALID")
        .when(authority.contains("@"), "URL_CREDENTIALS")
        .when(~scheme.isin(*protocols), "PROTOCOL_BLOCKED")
        .when(~host.isin(*hosts), "HOST_BLOCKED")
        .when(~port.isin(*ports), "PORT_BLOCKED")
        .when(url.rlike("#."), "URL_FRAGMENT")
    )


def storage_uri(uri: Column, scheme: str, bucket: str) -> Column:
    """The SHA-256 in a content-addressed URI scheme://bucket/name/aa/<sha>.ext; null if it is not such a URI."""
    path = rf"^{scheme}://{bucket}/[a-z0-9-]+/([0-9a-f]{{2}})/([0-9a-f]{{64}})\.[a-z0-9]+$"
    sha = F.regexp_extract(uri, path, 2)
    return F.when((sha != "") & (F.regexp_extract(uri, path, 1) == F.substring(sha, 1, 2)), sha)
