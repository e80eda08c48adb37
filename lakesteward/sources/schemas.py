"""Schemas of the input and output tables. Field names and types are fixed values."""

from __future__ import annotations

LISTING = (
    "name string, atime string, mtime string, ctime string, size_byte bigint, type string, "
    "acl string, `user` string, `group` string, file_type string, dt string"
)

QUERY_LOG = "query_id bigint, catalog string, db_name string, query string"

GRANTS = "grant_id bigint, catalog string, user_identity string, grant_sql string"

USERS = (
    "id int, createDate timestamp, updateDate timestamp, emailAddress string, owner string, updatedBy string, name string, "
    "password string, description string, groupIdList array<int>, groupNameList array<string>, status int, isVisible int, "
    "userSource int, userRoleList array<string>, otherAttributes string, syncSource string, firstName string, lastName string"
)

_RESOURCE = "struct<values: array<string>, isExcludes: boolean, isRecursive: boolean>"

_ITEM = (
    "users: array<string>, groups: array<string>, roles: array<string>, "
    "accesses: array<struct<type: string, isAllowed: boolean>>, "
    "conditions: array<struct<values: array<string>, type: string>>, delegateAdmin: boolean"
)

_RESOURCE_KINDS = (
    "database", "table", "column", "global", "hiveservice", "udf", "url",
    "bucket", "mountpoint", "path", "queue", "keyname",
)

POLICY = (
    "id int, guid string, isEnabled boolean, version int, service string, name string, "
    "policyType int, policyPriority int, description string, isAuditEnabled boolean, "
    f"resources struct<{', '.join(f'`{k}`: {_RESOURCE}' for k in _RESOURCE_KINDS)}>, "
    f"policyItems array<struct<{_ITEM}>>, denyPolicyItems array<struct<{_ITEM}>>, "
    "isDenyAllElse boolean, "
    f"allowExceptions array<struct<{_ITEM}>>, denyExceptions array<struct<{_ITEM}>>, "
    "dataMaskPolicyItems array<struct<dataMaskInfo: struct<conditionExpr: string, dataMaskType: string, "
    f"valueExpr: string>, {_ITEM}>>, "
    f"rowFilterPolicyItems array<struct<rowFilterInfo: struct<filterExpr: string>, {_ITEM}>>, "
    "serviceType string, options struct<POLICY_VALIDITY_SCHEDULES: string>, "
    "validitySchedules array<struct<startTime: string, endTime: string, timeZone: string>>, "
    "policyLabels array<string>, zoneName string"
)

SERVICE_DEFINITION = (
    "id int, guid string, isEnabled boolean, createTime bigint, updateTime bigint, version int, name string, displayName string, "
    "implClass string, label string, description string, "
    "options struct<enableDenyAndExceptionsInPolicies: string, `ui.pages`: string>, "
    "configs array<struct<itemId: int, name: string, type: string, subType: string, mandatory: boolean, validationRegEx: string, "
    "validationMessage: string, uiHint: string, label: string, defaultValue: string>>, "
    "resources array<struct<itemId: int, name: string, type: string, level: int, mandatory: boolean, lookupSupported: boolean, "
    "recursiveSupported: boolean, excludesSupported: boolean, matcher: string, "
    "matcherOptions: struct<wildCard: string, ignoreCase: string, pathSeparatorChar: string>, validationRegEx: string, "
    "validationMessage: string, uiHint: string, label: string, description: string, accessTypeRestrictions: array<string>, "
    "isValidLeaf: boolean, parent: string>>, "
    "accessTypes array<struct<itemId: int, name: string, label: string, impliedGrants: array<string>>>"
)
