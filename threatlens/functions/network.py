"""IPv4 helpers as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatlens.config import Zones

_IPV4 = r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})$"


def ipv4_to_long(ip: Column) -> Column:
    """Dotted quad -> 32-bit value as long; null for anything that is not one."""
    octets = [F.regexp_extract(ip, _IPV4, i).try_cast("long") for i in range(1, 5)]
    valid = F.lit(True)
    for o in octets:
        valid = valid & o.isNotNull() & (o <= 255)
    value = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    return F.when(valid, value)


def _cidr_bounds(cidr: str) -> tuple[int, int]:
    net, bits = cidr.split("/")
    parts = [int(p) for p in net.split(".")]
    base = (parts[0] << 24) | (parts[1] << 16) | (parts[2] << 8) | parts[3]
    size = 1 << (32 - int(bits))
    base &= ~(size - 1) & 0xFFFFFFFF
    return base, base + size - 1


def in_cidr(ip: Column, cidr: str) -> Column:
    lo, hi = _cidr_bounds(cidr)
    v = ipv4_to_long(ip)
    return F.coalesce(v.between(lo, hi), F.lit(False))


def zone_of(value: Column, zones: Zones = Zones()) -> Column:
    """Zone name of the first network that contains the address, given as its 32-bit
    value, else ``zones.other``."""
    expr = None
    for zone, cidr in zones.ranges():
        cond = value.between(*_cidr_bounds(cidr))
        expr = F.when(cond, zone) if expr is None else expr.when(cond, zone)
    return expr.otherwise(zones.other)


def ip_zone(ip: Column, zones: Zones = Zones()) -> Column:
    return zone_of(ipv4_to_long(ip), zones)


def with_ip_value(df: DataFrame, ip: str, out: str) -> DataFrame:
    """Add the 32-bit value of an address; it is matched and split once, in projections of
    their own, however often the value is used."""
    parts = F.when(F.col(ip).rlike(_IPV4), F.transform(F.split(F.col(ip), r"\."), lambda x: x.cast("long")))
    df = df.withColumn("_octets", parts)
    octets = [F.get("_octets", F.lit(i)) for i in range(4)]
    value = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    return df.withColumn(out, F.when(F.array_max("_octets") <= 255, value)).drop("_octets")
