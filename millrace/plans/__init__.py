from millrace.plans.naming import file_name

__all__ = ["file_name"]
