from .workflow import WorkflowResult, run_audited, run_workflow, write_outputs

__all__ = ["WorkflowResult", "run_audited", "run_workflow", "write_outputs"]
