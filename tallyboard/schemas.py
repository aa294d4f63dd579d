"""Typed schemas of the landed feeds and of the tables made from them (DDL text).

A landed feed is one JSON document per reply: the request key, the HTTP status
(NULL when no reply came), the page number where the feed is paged, and the body.
"""

from __future__ import annotations

_ENDPOINT = (
    "id string, sensor_version string, deployment_type string, os_version string, "
    "organization_name string, status string, registered_time string, organization_id string, "
    "deregistered_time string, last_reported_time string, sensor_out_of_date boolean, "
    "last_contact_time string, os string, av_vdf_version string, av_engine string"
).replace(" string", ":string").replace(" boolean", ":boolean")

LANDED = {
    "orgs": "inst_id string, status int, body struct<organization:struct<orgKey:string>>",
    "audit": "inst_id string, search string, status int, "
             "body struct<entries:array<struct<loginName:string,eventTime:bigint,description:string,flagged:boolean,verbose:boolean>>>",
    "endpoints": "inst_id string, page int, status int, "
                 f"body struct<num_found:bigint,results:array<struct<{_ENDPOINT}>>>",
    "alerts": "inst_id string, status int, "
              "body struct<results:array<struct<field:string,values:array<struct<id:string,total:bigint>>>>>",
    "kits": "backend string, status int, body struct<publishedKits:map<string,map<string,"
            "array<struct<hash:string,createTime:bigint,status:string>>>>>",
    "connectors": "inst_id string, status int, body struct<entries:array<struct<createTime:bigint,connectorId:string,"
                  "apiKey:string,lastUpdatedTime:bigint,orgId:string,connectorType:string,"
                  "notificationState:struct<lastSimNotificationKey:struct<eventTime:bigint>,"
                  "lastAuditLogKey:struct<eventTime:bigint>>,stats:struct<lastReportedTime:bigint>,"
                  "name:string,description:string>>>",
    "forwarders": "inst_id string, status int, body array<struct<id:string,org_key:string,name:string,"
                  "enabled:boolean,s3_bucket_name:string,s3_prefix:string,type:string,"
                  "create_time:string,update_time:string>>",
    "dashboards": "inst_id string, status int, body struct<message:string,threatSummary:struct<"
                  "ATTACKS_STOPPED:map<string,map<string,double>>>>",
    "policies": "prod string, status int, body struct<list:array<struct<orgId:string,id:string,name:string,"
                "priority:string,numDevices:bigint>>>",
    "policy": "prod string, status int, body struct<orgId:string,id:string,name:string,"
              "policy:struct<rules:array<struct<operation:string,action:string,"
              "application:struct<type:string,value:string>>>>>",
    "pages": "page_id bigint, tag string, html string",
}

TABLES = {
    "roster": "inst_id string, backend string, org_id string",
    "customers": "inst_id string, prod string, org_id string, org_key string",
    "endpoints": "inst_id string, id string, sensor_version string, deployment_type string, os_version string, "
                 "org_name string, status string, reg_time timestamp_ntz, org_id string, dereg_time timestamp_ntz, "
                 "last_reported_time timestamp_ntz, sensor_ood boolean, last_contact_time timestamp_ntz, os string, "
                 "av_vdf_version string, av_engine string, fetch_status string",
    "audit": "inst_id string, user string, event_time bigint, description string",
    "alerts": "inst_id string, open bigint, dismissed bigint, terminated bigint, denied bigint, allow_log bigint, "
              "ran bigint, not_ran bigint, policy_applied bigint, policy_not_applied bigint, fetch_status string",
    "kits": "backend string, os string, version string, hash string, create_time bigint, status string",
    "connectors": "inst_id string, create_time bigint, connector_id string, api_key string, last_updated bigint, "
                  "org_id string, connector_type string, last_event bigint, last_report bigint, name string, "
                  "description string, fetch_status string",
    "forwarders": "inst_id string, id string, org_key string, name string, enabled boolean, s3_bucket_name string, "
                  "s3_prefix string, type string, create_time timestamp_ntz, update_time timestamp_ntz, "
                  "fetch_status string",
    "policy_ids": "inst_id string, org_id string, policy_id string, policy_name string, priority string, "
                  "num_devices bigint",
    "rules": "inst_id string, policy_id string, rule_name string, operation string, action string, "
             "rule_type string, rule_definition string",
    "version_support": "os string, version string, standard date, extended date, eol date, current_level string",
    "cse_activity": "account string, activity_date date",
}

# Warehouse inputs: only the columns the extracts touch.
WAREHOUSE = {
    "account": "account_id string, name string, arr double, csm_id string, cse_id string, csm_role string, "
               "gsm_score int, gs_overall int, gs_last_update_date date, tier string, previous_tier string, "
               "csm_comments string, gs_adoption_comments string, parent_account string",
    "installation": "inst_id string, account_id string, backend string, org_id string, licences bigint, "
                    "status string, type string, created timestamp_ntz, half_deployed date",
    "user": "user_id string, name string, email string, manager_id string",
    "subscription": "account_id string, product_group string",
    "opportunity": "opp_id string, account_id string, amount double, forecast string, close_date date, "
                   "type string, product_family string",
    "case": "account_id string, product_group string, created string, status string",
    "cta": "account_id string, closed_date date, status string, reason string",
    "deployed_licence": "prodkey string, calendarid bigint, deployed_last_day bigint, month_average double",
    "activity_timeline": "account_id string, activity_date date, type_name string",
}
