"""Input schemas (Spark DDL).  A key that a record lacks reads as NULL."""

COUNT = "STRUCT<totalCount: BIGINT>"

REPOS = """
  name STRING, nameWithOwner STRING, owner STRUCT<login: STRING>, url STRING, description STRING,
  createdAt STRING, updatedAt STRING, pushedAt STRING,
  stargazerCount BIGINT, forkCount BIGINT, diskUsage BIGINT,
  primaryLanguage STRUCT<name: STRING>, licenseInfo STRUCT<name: STRING, spdxId: STRING>,
  isArchived BOOLEAN, isFork BOOLEAN, isPrivate BOOLEAN
"""

REPO_COUNTS = f"""
  nameWithOwner STRING, pullRequests {COUNT}, mergedPRs {COUNT},
  issues {COUNT}, closedIssues {COUNT}, openIssues {COUNT}
"""

PULL_REQUEST = """STRUCT<
  number: BIGINT, mergedAt: STRING, baseRefOid: STRING,
  mergeCommit: STRUCT<oid: STRING, committedDate: STRING>,
  repository: STRUCT<owner: STRUCT<login: STRING>, name: STRING>>"""

ISSUES = f"""
  repo_name STRING, number BIGINT, title STRING, body STRING, state STRING,
  createdAt STRING, closedAt STRING, updatedAt STRING,
  timeline ARRAY<STRUCT<closer: {PULL_REQUEST}, source: {PULL_REQUEST}>>
"""

MAPPINGS = """
  type STRING, issue_number BIGINT, pr_number BIGINT, issue_repo STRING, pr_repo STRING,
  mergedAt STRING, base_commit STRING, merge_commit STRING, committed_date STRING,
  issue_created_at STRING, issue_closed_at STRING, issue_updated_at STRING, issue_title STRING,
  repo_name STRING
"""

COMMENT_EDGES = """ARRAY<STRUCT<node: STRUCT<
  author: STRUCT<login: STRING>, body: STRING, createdAt: STRING>>>"""

DETAILS = f"""
  repo_name STRING, number BIGINT, title STRING, body STRING,
  comments STRUCT<edges: {COMMENT_EDGES}>
"""

# Report documents.  Numbers that a format writes as text stay text here and are
# cast by the operator, so that a bad number marks its report and nothing else.
PYTEST_REPORT = "tests ARRAY<STRUCT<nodeid: STRING, outcome: STRING>>"

GO_EVENT = "Action STRING, Package STRING, Test STRING, Elapsed DOUBLE, Output STRING"

RUST_EVENT = """
  type STRING, event STRING, name STRING, exec_time DOUBLE, stdout STRING,
  passed BIGINT, failed BIGINT, ignored BIGINT
"""

RSPEC = """
  summary STRUCT<example_count: BIGINT, failure_count: BIGINT, pending_count: BIGINT>,
  examples ARRAY<STRUCT<
    description: STRING, full_description: STRING, run_time: DOUBLE, status: STRING,
    exception: STRUCT<message: STRING, backtrace: STRING>>>
"""

GTEST = """
  testsuites ARRAY<STRUCT<name: STRING, testsuite: ARRAY<STRUCT<
    name: STRING, status: STRING, time: STRING, failures: ARRAY<STRUCT<failure: STRING>>>>>>,
  tests ARRAY<STRUCT<name: STRING, classname: STRING, time: DOUBLE, status: STRING>>
"""

JEST = """
  numTotalTests BIGINT, numPassedTests BIGINT, numFailedTests BIGINT,
  numPendingTests BIGINT, numTodoTests BIGINT
"""

MOCHA = "_tests STRING, _failures STRING, _errors STRING, _skipped STRING"

JACOCO = "CLASS STRING, INSTRUCTION_MISSED BIGINT, INSTRUCTION_COVERED BIGINT"

DEFINITIONS = """
  fn STRING, intent STRING, intent_type STRING, intent_name STRING, l INT, r INT,
  gt STRING, doc STRING, source STRING, seq INT
"""

# Columns that jobs need in their input tables.
TASK_LISTS = ("PASS_TO_PASS", "FAIL_TO_PASS")
VALIDATED = ("repo_name", "pr_number", "issue_number", "map_issue_pr_ok", "base_commit", "merge_commit")
DIFFS = ("item_id", "cloned", "fetched", "full_patch", "error")
CONTEXTS = ("fn", "line", "context")
OUTCOMES = ("nodeid", "outcome")

_CASE = """STRUCT<_name: STRING, _classname: STRING, _class: STRING, _time: STRING,
  failure: ARRAY<STRUCT<_message: STRING, _VALUE: STRING>>,
  error: ARRAY<STRUCT<_message: STRING, _VALUE: STRING>>,
  skipped: ARRAY<STRUCT<_message: STRING, _VALUE: STRING>>>"""
_SUITE = "STRUCT<_tests: STRING, _failures: STRING, _errors: STRING, _skipped: STRING>"

# All suites of a JUnit document beside each other, and all their cases.
JUNIT = f"STRUCT<s: ARRAY<{_SUITE}>, testcase: ARRAY<{_CASE}>, _corrupt_record: STRING>"
