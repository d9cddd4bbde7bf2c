"""Record layouts.

The field names below are fixed values: they are the names the archives use, and readers
of the results know the columns by them.
"""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DataType, DoubleType, MapType, StringType, StructType


def struct(**fields: str | DataType) -> StructType:
    """A struct from names and types; types are Spark type names or type objects."""
    out = StructType()
    for name, kind in fields.items():
        out.add(name, kind)
    return out


JOB_FIELDS = struct(
    GlobalJobId="string",
    Workflow="string",
    WMAgent_RequestName="string",
    ScheddName="string",
    WMAgent_JobID="string",
    RecordTime="long",
    JobFailed="long",
    Status="string",
    Site="string",
    Tier="string",
    Type="string",
    WallClockHr="double",
    CpuTimeHr="double",
    CommittedCoreHr="double",
    CommittedWallClockHr="double",
    MaxWallTimeMins="double",
    RequestCpus="double",
    ChirpCMSSWReadTimeMsecs="double",
    ChirpCMSSWElapsed="double",
    CpuEff="double",
    CpuEffOutlier="integer",
)

JOB_ARCHIVE = struct(data=JOB_FIELDS)

STEP = struct(
    name="string",
    site="string",
    performance=struct(
        cpu=struct(NumberOfStreams="integer", NumberOfThreads="integer", TotalJobCPU="double", TotalJobTime="double"),
        storage=struct(writeTotalMB="double", readTotalMB="double", writeTotalSecs="string", readTotalSecs="string"),
        memory=struct(PeakValueRss="double", PeakValueVsize="double"),
    ),
    output=ArrayType(struct(acquisitionEra="string")),
)

WORK_FIELDS = struct(
    task="string",
    wmats="long",
    meta_data=struct(fwjr_id="string", jobtype="string", jobstate="string", ts="long"),
    steps=ArrayType(STEP),
)

WORK_ARCHIVE = struct(data=WORK_FIELDS, metadata=struct(timestamp="long"))

FLAT_STEP = struct(
    ts="long",
    Task="string",
    fwjr_id="string",
    JobType="string",
    Site="string",
    acquisition_era=ArrayType(StringType()),
    StepName="string",
    nstreams="integer",
    nthreads="integer",
    cpu_time="double",
    job_time="double",
    threads_total_job_time="double",
    era_length="integer",
    number_of_steps="integer",
    write_total_mb="double",
    read_total_mb="double",
    read_total_secs="double",
    write_total_secs="double",
    peak_rss="double",
    peak_v_size="double",
)

# One range-query answer: series with a label set and [time, "value"] samples.
LABELS = MapType(StringType(), StringType())
SERIES_MATRIX = struct(
    status="string",
    data=struct(
        resultType="string",
        result=ArrayType(struct(metric=LABELS, values=ArrayType(ArrayType(StringType())))),
    ),
)

# One line of a time-series export: parallel arrays, times in milliseconds.
SERIES_EXPORT = struct(metric=LABELS, values=ArrayType(DoubleType()), timestamps=ArrayType(DoubleType()))

# What the enumerated fields of a job document may hold.
ALLOWED_JOB_VALUES = {
    "Pool": ["Global", "CERN", "ITB", "Volunteer", "HEPCloud"],
    "WMTool": ["WMAgent", "Unknown", "User", "HammerCloud"],
    "SubmissionTool": ["CRAB", "WMAgent", "CMSConnect", "SiteSchedd"],
    "Type": ["Production", "Analysis", "Test", "Tier0"],
    "JobType": [
        "LogCollect", "Merge", "Processing", "Production", "Harvesting", "Cleanup", "Skim", "Repack", "Express", "Analysis",
    ],
    "TaskType": ["Reco", "Digi", "Gen", "GenSimDigi", "scriptExe", "CMSRun", "HCtest", "HCother"],
    "PrimaryInputType": ["MC", "Data", "NONE"],
    "PrimaryInputLocation": ["Onsite", "Offsite", "Mixed", "NONE"],
    "SecondaryInputType": ["MC", "Data", "NONE"],
    "SecondaryInputLocation": ["Onsite", "Offsite", "Mixed", "NONE"],
    "JobFailed": [0, 1],
    "ErrorType": ["Env", "Exe", "Stageout", "Publication", "Internal", "FileOpen", "DataRead", "Others"],
    "ErrorCategory": ["Site", "Application", "WMTool"],
}
