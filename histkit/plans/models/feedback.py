"""Change logs of the feedback application.

Fixed values: table, key and column names, types and renames.
A line reads ``name type [input column]``.
"""

from ..specs import CdcSpec, columns

FEEDBACK = (
    CdcSpec(
        "feedback_calibration",
        ("feedback_raw", "feedback_calibration_history"),
        "feedback_calibration_key",
        columns("""
            id bigint
            name string
            slug string
            created timestamp
            last_updated timestamp
            round_id bigint
            completed boolean
            in_progress boolean
            chime_intervals string
            chime_sound_id bigint
            is_locked boolean
            hide_review_details boolean
            duration_actual bigint
            duration_estimate bigint
            anonymize_shard boolean
        """),
    ),
    CdcSpec(
        "feedback_dimension",
        ("feedback_raw", "ckapp_dimension_history"),
        "dimension_key",
        columns("""
            id bigint
            name string
            description string
            rubric_id bigint
            seq bigint
            is_rating_field boolean
        """),
    ),
    CdcSpec(
        "feedback_dimension_value_feedback_item",
        ("feedback_raw", "feedback_dimensionvaluefeedbackitem_history"),
        "dimension_value_key",
        columns("""
            id bigint
            value bigint
            dimension_id bigint
            ordered_feedback_item_id bigint
            draft_value bigint
            original_value bigint
            employee_ptl_info_id bigint
        """),
    ),
    CdcSpec(
        "feedback_employee_ptl_info",
        ("feedback_raw", "feedback_employeeptlinfo_history"),
        "employee_ptl_info_key",
        columns("""
            id bigint
            employee_id bigint
            last_proposed_ptl_id bigint
            last_recorded_ptl_id bigint
            created_on timestamp
            last_original_ptl_id bigint
            updated_on timestamp
        """),
    ),
    CdcSpec(
        "feedback_employee_ptl_snapshot",
        ("feedback_raw", "feedback_employeeptlsnapshot_history"),
        "employee_ptl_snapshot_key",
        columns("""
            id bigint
            snapshot_date timestamp
            ptl_score double
            is_recorded boolean
            author_employee_id bigint
            current_job_profile_id bigint
            employee_id bigint
            round_id bigint
            created_on timestamp
        """),
    ),
    CdcSpec(
        "feedback_feedback",
        ("feedback_raw", "feedback_feedback_history"),
        "feedback_key",
        columns("""
            id bigint
            created timestamp
            last_updated timestamp
            form_name string
            feedback_type bigint
            level_id bigint
            reviewee_id bigint
            reviewer_id bigint
            round_id bigint
            rubric_id bigint
            created_duration bigint
            edit_locked boolean
            share_with_reviewee boolean
            role_id bigint
            reveal boolean
            saved_by_user boolean
            attributed boolean
            show_ratings boolean
            is_drafted boolean
            is_archived boolean
            feedback_source bigint
            next_role_id bigint
            custom_form_id bigint
            employee_ptl_info_id bigint
        """),
    ),
    CdcSpec(
        "feedback_form_builder_form",
        ("feedback_raw", "form_builder_form_history"),
        "form_builder_form_key",
        columns("""
            id bigint
            name string
            type bigint
            status bigint
            created_on timestamp
            is_deleted boolean
            form_structure json
            meta json
            last_modified_by string meta:lastModifiedBy
            created_by_id bigint
            is_archived boolean
            modified_by_id bigint
            modified_on timestamp
        """),
    ),
    CdcSpec(
        "feedback_function",
        ("feedback_raw", "ckapp_function_history"),
        "function_key",
        columns("""
            id bigint
            name string
            organization_id bigint
            is_archived boolean
        """),
    ),
    CdcSpec(
        "feedback_integer_feedback_item",
        ("feedback_raw", "feedback_integerfeedbackitem_history"),
        "integer_feedback_item_key",
        columns("""
            id bigint
            name string
            value bigint
            ordered_feedback_item_id bigint
            draft_value bigint
        """),
    ),
    CdcSpec(
        "feedback_level",
        ("feedback_raw", "ckapp_level_history"),
        "level_key",
        columns("""
            id bigint
            name string
            description string
            rubric_id bigint
            seq bigint
            is_specified boolean
        """),
    ),
    CdcSpec(
        "feedback_organization",
        ("feedback_raw", "ckapp_organization_history"),
        "organization_key",
        columns("""
            id bigint
            name string
            feedback_request_template_id bigint
            feedback_reminder_template_id bigint
            peerfeedback_form string
            review_form string
            selfeval_form string
            upward_feedback_rubric string
            hide_role boolean
            hide_overall_rating boolean
            hide_selfeval_rating_until_locked boolean
            upward_feedback_rubric_id bigint
            reveal_rating boolean
            anytime_feedback_rubric_id boolean
            is_peer_feedback_attributed boolean
            show_peer_feedback_ratings boolean
            auto_share_peer_feedback boolean
            hide_selfeval_and_peerfeedback_on_review boolean
            show_awards_page boolean
            show_private_feedback_in_calibration boolean
            hide_previous_quarter_review boolean
        """),
    ),
    CdcSpec(
        "feedback_role",
        ("feedback_raw", "ckapp_role_history"),
        "role_key",
        columns("""
            id bigint
            name string
            seq bigint
            rank bigint
            is_specified boolean
            function_id bigint
            level_id bigint
        """),
    ),
    CdcSpec(
        "feedback_round",
        ("feedback_raw", "feedback_round_history"),
        "round_key",
        columns("""
            id bigint
            name string
            slug string
            created_date timestamp created
            last_updated_date timestamp last_updated
            peer_feedback_due_date timestamp peer_feedback_due
            reviews_due_date timestamp reviews_due
            self_evals_due_date timestamp self_evals_due
            is_locked bigint locked
        """),
    ),
    CdcSpec(
        "feedback_rubric",
        ("feedback_raw", "ckapp_rubric_history"),
        "rubric_key",
        columns("""
            id bigint
            name string
        """),
    ),
    CdcSpec(
        "feedback_workday_profile",
        ("feedback_raw", "workdayprofile_history"),
        "workday_profile_key",
        columns("""
            id bigint
            active boolean
            first_name string
            last_name string
            preferred_first_name string
            ldap string
            employee_id string
            email string
            hire_date timestamp
            job_profile string
            job_profile_start_date timestamp
            job_family string
            job_family_group string
            supervisory_organization_id string
            supervisory_organization_name string
            business_unit string
            division string
            group string
            cost_center_id bigint
            cost_center_name string
            manager_ldap string
            manager_email string
            manager_id bigint
            user_id bigint
            manager_employee_id string
            current_office string
            home_office string
        """),
    ),
)
