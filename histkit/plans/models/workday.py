"""JSON snapshots of the HR system.

Fixed values: table, key and column names, types and JSON paths.
A line reads ``name type path``; the path starts at the document root.
"""

from ..specs import ChildColumns, Column, SnapshotSpec, columns

REPORT_DATE = Column("timestamp_effective", "date_timestamp", "$.Report_Effective_Date")


def _snapshots(name: str, unique_key: str, text: str, **more) -> SnapshotSpec:
    given = {"key": "workday_id", "effective": REPORT_DATE, **more}
    return SnapshotSpec(name, ("workday_raw", name), unique_key, columns(text, path=True), **given)


WORKDAY = (
    _snapshots(
        "workday_companies",
        "company_key",
        """
            workday_id string Workday_ID
            last_updated_date date Last_Updated_Date
            created_date date Created_Moment
            reference_id string Reference_ID
            is_deleted boolean Inactive
            company_code string Code
            company_name string Name
        """,
    ),
    _snapshots(
        "workday_cost_centers",
        "cost_center_key",
        """
            workday_id string Workday_ID
            cost_center_name string Name
            reference_id string Reference_ID
            cost_center_code string Code
            included_by_organizations_group json Included_by_Organizations_group
            is_deleted boolean Inactive
            inactive_date date Inactive_Date
            created_date date Created_Moment
        """,
    ),
    _snapshots(
        "workday_custom_organizations",
        "custom_organization_key",
        """
            workday_id string Workday_ID
            custom_organization_code string Code
            custom_organization_name string Name
            custom_organization_type string Type
            custom_organization_subtype string Subtype
            superior_organization_id string Superior_Organization_ID
            last_updated_date date Last_Updated_Date
            reference_id string Reference_ID
            is_deleted boolean Inactive
            inactive_date date Inactive_Date
        """,
    ),
    _snapshots(
        "workday_job_profiles",
        "job_profiles_key",
        """
            workday_id string Workday_ID
            compensation_grade_hierarchy string Compensation_Grade_Hierarchy
            job_profile_name string Job_Profile_Name
            compensation_grade string Compensation_Grade
            reference_id string Reference_ID
            job_profile_exempt_group string Job_Profile_Exempt_Group
            job_profile_pay_rate_group string Job_Profile_Pay_Rate_Group
            job_classifications_group string Job_Classifications_group
            job_family string Job_Families_on_Job_Profile_group[0].Job_Family
            job_family_group string Job_Families_on_Job_Profile_group[0].Job_Family_Group
            job_families_on_job_profile_group string Job_Families_on_Job_Profile_group
            is_deleted boolean Inactive
        """,
    ),
    _snapshots(
        "workday_locations",
        "location_key",
        """
            workday_id string Workday_ID
            city string City
            state_code string State_Code
            state_name string State_Name
            country_code string Country_Code
            country_name string Country_Name
            region string Region
            location_name string Location_Name
            location_type string Location_Type
            location_usage string Location_Usage
            reference_id string Reference_ID
            time_zone string Time_Zone
            is_deleted boolean Inactive
            inactive_date date Inactive_Date
            location_hierarchies_group string Location_Hierarchies_group
            superior_location string Superior_Location
        """,
    ),
    _snapshots(
        "workday_locations_hierarchy",
        "location_hierarchy_key",
        """
            workday_id string Workday_ID
            name string Name
            superior_organization string Superior_Organization
            level_01_from_the_top string Level_01_from_the_Top
            level_02_from_the_top string Level_02_from_the_Top
            level_03_from_the_top string Level_03_from_the_Top
            level_04_from_the_top string Level_04_from_the_Top
            level_05_from_the_top string Level_05_from_the_Top
            level_06_from_the_top string Level_06_from_the_Top
            level_07_from_the_top string Level_07_from_the_Top
            time_zone string Time_Zone
        """,
    ),
    _snapshots(
        "workday_supervisory_organizations",
        "supervisory_organization_key",
        """
            workday_id string Workday_ID
            name string Name
            reference_id string Reference_ID
            manager_id string Manager_ID
            superior_organization string Superior_Organization
            is_deleted boolean Inactive
            inactive_date date Inactive_date
        """,
        require_not_null=("timestamp_effective",),
    ),
    _snapshots(
        "workday_suppliers",
        "supplier_key",
        """
            workday_id string Workday_ID
            status string Status
            last_updated_date date_timestamp Last_Updated_Date
            created_date date Created_Moment
            supplier_category string Supplier_Category
            supplier_name string Supplier_Name
        """,
    ),
    _snapshots(
        "workday_transactions",
        "transaction_key",
        """
            business_process_id string Business_Process_ID
            is_worker_bp boolean is_Worker_BP
            is_staffing_bp boolean is_Staffing_BP
            is_job_requisition_bp boolean is_Job_Requisition_BP
            is_personal_information_bp boolean is_Personal_Information_BP
            is_standalone_bp boolean is_Standalone_BP
            business_process_name string Business_Process_Name
            business_process_reason_category string Business_Process_Reason_Category
            business_process_reason string Business_Process_Reason
            business_process_type string Business_Process_Type
            part_of_business_process string Part_of_Business_Process
            date_time_completed date_timestamp Date_Time_Completed
            date_rescinded date Date_Rescinded
            corrected string Corrected
            last_correction_event_date date Last_Correction_Event_Date
            secondary_termination_reasons string Secondary_Termination_Reasons
            date_of_birth date Date_of_Birth
            gender string Gender
            ethnicity string Ethnicity
            pronouns string Pronouns
            gender_identity string Gender_Identity
            sexual_orientation string Sexual_Orientation
            disability string Disability
            military_status string Military_Status
            employee_id string Employee_ID
            position_id string Position_ID
            business_title string Business_Title
            work_space_name string Work_Space_Name
            work_space_id string Work_Space_ID
            pay_rate_type string Pay_Rate_Type
            time_type string Time_Type
            requisition_id string Requisition_ID
            location string Location
            job_profile string Job_Profile
            work_email_address string Work_Email_Address
            job_requisition_organizations_group json Job_Requisition_Organizations_group
            worker_position_organizations_group json Worker_Position_Organizations_group
            budgeted_start_date date Budgeted_Start_Date
            finance_only_start_date date Finance_Only_Start_Date
            position_job_profile string Position_Job_Profile
            position_location string Position_Location
            position_time_type string Position_Time_Type
            position_title string Position_Title
            position_worker_type string Position_Worker_Type
            ta_forecasted_start_date date TA_Forecasted_Start_Date
            employee_contingent_worker_type string Employee_Contingent_Worker_Type
            ldap string LDAP
            public_pronoun string Public_Pronoun
        """,
        key="business_process_id",
        effective=Column("timestamp_effective", "date", "$.Effective_Date"),
        children=ChildColumns(
            path="$.Worker_Position_Organizations_group",
            id_field="Workday_ID",
            type_field="Type",
            types={
                "Company": "worker_position_company",
                "Cost Center": "worker_position_cost_center",
                "Functional Tier": "worker_position_functional_tier",
                "Market": "worker_position_market",
                "Pay Group": "worker_position_pay_group",
                "Segment": "worker_position_segment",
                "Supervisory": "worker_position_supervisory",
                "Vertical": "worker_position_vertical",
            },
            after="worker_position_organizations_group",
        ),
    ),
)
