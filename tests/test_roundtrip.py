"""Random rows written as OTLP/JSON and read back: whatever the text, names or order, the same rows return."""

import json
import random

from spanlake.sources import otlp

ALPHABET = "aZ09 ._-/\\\"'{}[]:,\n\t\r\u0000é漢😀 $`%"


def text(rng, longest=12):
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(longest)))


def attributes(rng):
    return {text(rng) + "k": text(rng) for _ in range(rng.randrange(5))}


def listed(rng, mapping):
    """As an attribute list, with an overridden copy of some keys in front and noise in between."""
    items = [{"key": k, "value": {"stringValue": v}} for k, v in mapping.items()]
    early = [{"key": k, "value": {"stringValue": "old"}} for k in mapping if rng.random() < 0.3]
    noise = [rng.choice([None, 3, "x", {}, {"key": ""}, {"key": None}]) for _ in range(rng.randrange(2))]
    return early + noise + items


def either(rng, *spellings):
    return rng.choice(spellings)


def nanos(rng):
    return rng.randrange(2**62)


def as_number(rng, value):
    return rng.choice([value, str(value)])


def test_logs(spark):
    rng = random.Random(11)
    payloads, expected = [], []
    for _ in range(60):
        envelopes = []
        for _ in range(rng.randrange(3)):
            resource = attributes(rng) | ({"service.name": text(rng)} if rng.random() < 0.7 else {})
            records = []
            for _ in range(rng.randrange(4)):
                row = {
                    "time": nanos(rng),
                    "trace": text(rng),
                    "severity": text(rng),
                    "number": rng.randrange(25),
                    "body": text(rng, 40),
                    "attributes": attributes(rng),
                }
                time = {either(rng, "timeUnixNano", "observedTimeUnixNano"): as_number(rng, row["time"])}
                record = time | {
                    "traceId": row["trace"],
                    "severityText": row["severity"],
                    "severityNumber": as_number(rng, row["number"]),
                    "body": {"stringValue": row["body"]},
                    "attributes": listed(rng, row["attributes"]),
                }
                records.append(dict(rng.sample(list(record.items()), len(record))))
                service = resource.get("service.name", "unknown_service")
                expected.append(
                    (row["time"], row["trace"], row["severity"], row["number"], service, row["body"], resource, row["attributes"])
                )
            scopes = [{either(rng, "logRecords", "log_records"): records}]
            envelopes.append(
                {
                    "resource": {"attributes": listed(rng, resource)},
                    either(rng, "scopeLogs", "instrumentationLibraryLogs"): scopes,
                }
            )
        ascii_only = rng.random() < 0.5
        payloads.append((json.dumps({"resourceLogs": envelopes}, ensure_ascii=ascii_only, indent=rng.choice([None, 1])),))
    raw = spark.createDataFrame(payloads, "raw string").repartition(4)
    got = [
        (r.TimestampNano, r.TraceId, r.SeverityText, r.SeverityNumber, r.ServiceName, r.Body, r.ResourceAttributes, r.LogAttributes)
        for r in otlp.parse_logs(raw).collect()
    ]
    assert len(got) > 50
    assert _same(got, expected)
    assert otlp.bad_payloads(raw).count() == 0


def _same(got, expected):
    """Equal up to the order of map entries."""

    def plain(row):
        return tuple(tuple(sorted(v.items())) if isinstance(v, dict) else v for v in row)

    return sorted(map(plain, got)) == sorted(map(plain, expected))


def test_histogram_points(spark):
    rng = random.Random(12)
    payloads, expected = [], []
    for _ in range(40):
        points = []
        for _ in range(rng.randrange(4)):
            size = rng.randrange(6)
            time, count, total = nanos(rng), rng.randrange(2**53), rng.choice([0.5, 12.0, 1e-3, 7.25])
            buckets, bounds = [rng.randrange(2**40) for _ in range(size)], [rng.random() * 100 for _ in range(max(0, size - 1))]
            labels = attributes(rng)
            expected.append((time, count, total, tuple(buckets), tuple(bounds), tuple(sorted(labels.items()))))
            points.append(
                {
                    "timeUnixNano": as_number(rng, time),
                    "count": as_number(rng, count),
                    "sum": as_number(rng, total),
                    either(rng, "bucketCounts", "bucket_counts"): [as_number(rng, b) for b in buckets],
                    either(rng, "explicitBounds", "explicit_bounds"): [as_number(rng, b) for b in bounds],
                    "attributes": listed(rng, labels),
                }
            )
        metric = {"name": "m", "histogram": {either(rng, "dataPoints", "data_points"): points}}
        payloads.append((json.dumps({"resourceMetrics": [{"scopeMetrics": [{"metrics": [metric]}]}]}),))
    raw = spark.createDataFrame(payloads, "raw string")
    got = [
        (r.TimestampNano, r.Count, r.Sum, tuple(r.BucketCounts), tuple(r.ExplicitBounds), tuple(sorted(r.Attributes.items())))
        for r in otlp.parse_metrics(raw).histogram.collect()
    ]
    assert len(got) > 30
    assert sorted(got) == sorted(expected)
