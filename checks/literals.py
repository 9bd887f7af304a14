"""Values the SQL expects, written out: a change in the code under test shows as a difference."""

# Seed rows, region boxes, catalog entries and relations.
COMPANIES = [('C001', 'Acme Corp', 'Retail'), ('C002', 'Globex Ltd', 'Finance'), ('C003', 'Innotech', 'Technology')]
BRANCHES = [('B001', 'NCR Branch', 'C001', 'NCR'),
 ('B002', 'Pune Branch', 'C001', 'WST'),
 ('B003', 'Kolkata Branch', 'C002', 'EST'),
 ('B004', 'Bangalore Branch', 'C003', 'SOU')]
MANAGERS = [('M001', 'Rohit Sharma', 'B001', 'Sales'),
 ('M002', 'Anjali Mehta', 'B002', 'Engineering'),
 ('M003', 'Karan Patel', 'B003', 'Finance'),
 ('M004', 'Sonal Gupta', 'B004', 'Product')]
PROJECTS = [('P001', 'HyperGrowth', 'C001', 'Sales'),
 ('P002', 'NeuralOps', 'C003', 'Engineering'),
 ('P003', 'SafeFinance', 'C002', 'Finance')]
REGION_BOXES = [('NCR-NOIDA', 'Noida', 'Delhi NCR', 28.5, 28.65, 77.3, 77.45),
 ('NCR-GGN', 'Gurgaon', 'Delhi NCR', 28.38, 28.53, 76.9, 77.15),
 ('NCR-SAKET', 'Saket', 'Delhi NCR', 28.5, 28.55, 77.18, 77.25),
 ('NCR-DWARKA', 'Dwarka', 'Delhi NCR', 28.55, 28.63, 77.02, 77.1),
 ('NCR-CP', 'ConnaughtPlace', 'Delhi NCR', 28.61, 28.64, 77.2, 77.24)]
TABLES = [('raw_user_stream_events', 'RAW', 'Ingested user events'),
 ('dim_company', 'DIM', 'Company hierarchy'),
 ('dim_branch', 'DIM', 'Branch mapping'),
 ('dim_manager', 'DIM', 'Manager dimension'),
 ('dim_employee', 'DIM', 'Employee details'),
 ('dim_project', 'DIM', 'Project information'),
 ('dim_region', 'DIM', 'Region mapping'),
 ('dim_time', 'DIM', 'Time dimension'),
 ('fact_user_activity', 'FACT', 'Aggregated user activity')]
RELATIONS = (('dim_branch', 'company_id', 'dim_company'),
 ('dim_manager', 'branch_id', 'dim_branch'),
 ('dim_employee', 'manager_id', 'dim_manager'),
 ('dim_employee', 'branch_id', 'dim_branch'),
 ('dim_employee', 'project_code', 'dim_project'),
 ('dim_project', 'company_id', 'dim_company'),
 ('fact_user_activity', 'company_id', 'dim_company'),
 ('fact_user_activity', 'branch_id', 'dim_branch'),
 ('fact_user_activity', 'manager_id', 'dim_manager'),
 ('fact_user_activity', 'employee_id', 'dim_employee'),
 ('fact_user_activity', 'project_code', 'dim_project'))
STREAM_ERROR_FORMULA = 'safe_float(None) → default'

# Columns of events and tables, in order.
EVENT_TEXT = ['event_id', 'event_ts', 'user_id', 'username', 'session_id', 'device_type', 'app_version', 'watch_time',
 'country', 'city', 'region_code', 'lat', 'lon', 'company_id', 'company_name', 'branch_id', 'branch_name',
 'department', 'manager_id', 'manager_name', 'employee_id', 'employee_name', 'project_code', 'project_name']
RAW = ['event_id', 'event_ts', 'ingestion_ts', 'user_id', 'username', 'session_id', 'device_type', 'app_version',
 'watch_time', 'country', 'city', 'region_code', 'lat', 'lon', 'company_id', 'company_name', 'branch_id',
 'branch_name', 'department', 'manager_id', 'manager_name', 'employee_id', 'employee_name', 'project_code',
 'project_name']
RAW_USER = ['event_id', 'event_ts', 'user_id', 'username', 'session_id', 'device_type', 'app_version', 'watch_time',
 'country', 'city', 'region_code', 'lat', 'lon', 'ingestion_ts']
FACT_USER_ACTIVITY = ['event_id', 'user_id', 'employee_id', 'project_code', 'watch_time', 'session_id', 'event_ts', 'ingestion_ts',
 'company_id', 'branch_id', 'manager_id', 'region_code']
DIM_REGION_BOX = ['region_code', 'region_name', 'city', 'min_lat', 'max_lat', 'min_lon', 'max_lon']
# Types of the columns that are not text.
TYPES = {
    "event_ts": "timestamp_ntz",
    "ingestion_ts": "timestamp_ntz",
    "watch_time": "double",
    "lat": "double",
    "lon": "double",
}
