"""Explicit schemas of the canonical tables; nothing in the package infers a schema."""

from __future__ import annotations

# Column that keeps the text of documents a reader could not decode.
CORRUPT = "_corrupt_record"

SOURCE_DETAILS = "STRUCT<url: STRING, radioStreamUrl: STRING>"

# One JSON task document. Keys outside this list are dropped, as the data contract asks.
TASK_JSON = f"""
    jobId STRING, taskId STRING, recordingId STRING, token STRING,
    taskPayload STRUCT<
        recordStartTime: TIMESTAMP, recordEndTime: TIMESTAMP, recordDuration: STRING,
        startTimeOverride: BIGINT, tdoOffsetMS: INT, sourceId: STRING,
        sourceDetails: {SOURCE_DETAILS}, scheduledJobId: STRING, url: STRING,
        cacheToS3Key: STRING, disableKafka: BOOLEAN, disableS3: BOOLEAN,
        scfsWriterBufferSize: INT, organizationId: BIGINT>
"""

SOURCE_JSON = f"id STRING, sourceType STRUCT<isLive: BOOLEAN>, details {SOURCE_DETAILS}"

# One job-status document: counters arrive as text.
JOB_STATUS = """
    data STRUCT<job: STRUCT<id: STRING, tasks: STRUCT<records: ARRAY<STRUCT<
        targetId: STRING,
        engine: STRUCT<id: STRING, name: STRING>,
        status: STRING,
        taskOutput: STRUCT<
            info: STRING, error: STRING, uptime: STRING, bytesRead: STRING,
            bytesWritten: STRING, heartbeats: STRING, messagesWritten: STRING,
            failureReason: STRING, failureMessage: STRING, engineInstanceId: STRING>,
        taskPayload: STRUCT<
            url: STRING, tdoId: STRING, organizationId: BIGINT, startTimeOverride: BIGINT>,
        executionLocation: STRUCT<data: STRUCT<name: STRING>>
    >>>>>
"""

_DESCRIPTORS = "ARRAY<STRUCT<_schemeIdUri: STRING, _value: STRING>>"
_SEGMENT_TEMPLATE = """STRUCT<
    _timescale: BIGINT, _media: STRING, _initialization: STRING, _startNumber: BIGINT,
    _presentationTimeOffset: BIGINT,
    SegmentTimeline: STRUCT<S: ARRAY<STRUCT<_t: BIGINT, _d: BIGINT, _r: BIGINT>>>>"""
_SEGMENT_LIST = """STRUCT<
    _timescale: BIGINT, _duration: BIGINT, _presentationTimeOffset: BIGINT,
    Initialization: STRUCT<_sourceURL: STRING>,
    SegmentURL: ARRAY<STRUCT<_media: STRING>>>"""
_REPRESENTATION = f"""STRUCT<
    _id: STRING, _mimeType: STRING, _width: BIGINT, _height: BIGINT, _frameRate: STRING,
    _codecs: STRING, _bandwidth: BIGINT, _audioSamplingRate: STRING,
    ContentProtection: {_DESCRIPTORS},
    SegmentTemplate: {_SEGMENT_TEMPLATE},
    SegmentList: {_SEGMENT_LIST}>"""
# segmentAlignment is a union of integer and boolean, hence text here.
_ADAPTATION_SET = f"""STRUCT<
    _mimeType: STRING, _segmentAlignment: STRING, _subsegmentAlignment: STRING,
    _startWithSAP: BIGINT, _subsegmentStartsWithSAP: BIGINT, _bitstreamSwitching: BOOLEAN,
    _lang: STRING, ContentProtection: {_DESCRIPTORS}, Representation: ARRAY<{_REPRESENTATION}>>"""

MANIFEST = f"""
    _xmlns STRING, _type STRING, _minimumUpdatePeriod STRING, _availabilityStartTime STRING,
    _mediaPresentationDuration STRING, _minBufferTime STRING, _suggestedPresentationDelay STRING,
    _timeShiftBufferDepth STRING, _publishTime STRING, _profiles STRING,
    Period ARRAY<STRUCT<_start: STRING, _id: STRING, AdaptationSet: ARRAY<{_ADAPTATION_SET}>>>
"""

# What rendition choice and single-audio detection need of a manifest.
MANIFEST_RENDITIONS = """
    Period ARRAY<STRUCT<_id: STRING, AdaptationSet: ARRAY<STRUCT<
        Representation: ARRAY<STRUCT<_id: STRING, _mimeType: STRING, _bandwidth: BIGINT>>>>>>
"""

# What the position, type and segment totals of renditions need of one: Periods bound open repeats.
MANIFEST_TOTALS = """
    _mediaPresentationDuration STRING,
    Period ARRAY<STRUCT<_id: STRING, _start: STRING, _duration: STRING, AdaptationSet: ARRAY<STRUCT<
        _mimeType: STRING,
        Representation: ARRAY<STRUCT<
            _id: STRING, _mimeType: STRING, _bandwidth: BIGINT,
            SegmentTemplate: STRUCT<
                _timescale: BIGINT, _presentationTimeOffset: BIGINT,
                SegmentTimeline: STRUCT<S: ARRAY<STRUCT<_t: BIGINT, _d: BIGINT, _r: BIGINT>>>>,
            SegmentList: STRUCT<
                _duration: BIGINT, SegmentURL: ARRAY<STRUCT<_media: STRING>>>>>>>>>
"""

# What listed segments need.
MANIFEST_SEGMENTS = """
    Period ARRAY<STRUCT<_id: STRING, AdaptationSet: ARRAY<STRUCT<
        Representation: ARRAY<STRUCT<
            _id: STRING,
            SegmentList: STRUCT<
                Initialization: STRUCT<_sourceURL: STRING>,
                SegmentURL: ARRAY<STRUCT<_media: STRING>>>>>>>>>
"""

# What the times and URLs of segments need.
MANIFEST_TIMES = f"""
    _mediaPresentationDuration STRING,
    Period ARRAY<STRUCT<_id: STRING, _start: STRING, _duration: STRING, AdaptationSet: ARRAY<STRUCT<
        Representation: ARRAY<STRUCT<
            _id: STRING, _bandwidth: BIGINT, SegmentTemplate: {_SEGMENT_TEMPLATE}, SegmentList: {_SEGMENT_LIST}>>>>>>
"""
